"""First rows of each key over a manifest that keeps arriving, and a sink whose batches can be repeated.

Spark keeps the keys seen so far in its state store, partitioned by key; of the rows themselves nothing is kept. A batch that is run again after a failure
finds the state of the batch before, and replaces what it wrote the first time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from ..operators.dedupe import row_digest

_KEY = "_first_key"
_BATCH_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 500, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def first_arrivals(rows: DataFrame, key: str | Sequence[str], order: str = "row_id") -> DataFrame:
    """The first row of each key: of the rows that arrive in one batch the least by ``order`` (nulls last), and none of later batches.

    Null keys are a key like any other. Each Arrow batch sends on one row a key, so a key that a third of all rows have
    reaches its group as few rows. State grows by a digest for each distinct key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    schema = rows.schema
    # Rows are held on both sides of Python by the batch, several times over; whole texts make ten thousand of them large.
    for name, most in _BATCH_LIMITS.items():
        now = rows.sparkSession.conf.get(name).lower().removesuffix("b")
        # A size with a unit, or none at all, is taken for too much.
        if not now.isdigit() or not 0 < int(now) <= most:
            rows.sparkSession.conf.set(name, str(most))
    marked = rows.withColumn(_KEY, F.hex(row_digest(*keys)))

    def least(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.sort_values(order, kind="stable", na_position="last").drop_duplicates(_KEY)

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield least(batch)

    def first(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = None
        for frame in frames:
            if not state.exists and len(frame):
                best = least(frame if best is None else pd.concat([best, frame]))
        if best is not None:
            state.update((True,))
            yield best[schema.fieldNames()]

    seen = T.StructType([T.StructField("seen", T.BooleanType())])
    reduced = marked.mapInPandas(merged, marked.schema)
    return reduced.groupBy(_KEY).applyInPandasWithState(first, schema, seen, "append", "NoTimeout")


def start_batches(rows: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Write each batch of a stream to ``path/batch=<number>`` as Parquet; a batch that is repeated replaces its folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
