"""Row filters on manifests that keep arriving.

Reasons are column expressions without state, so the filters of a batch job also run on a stream; nothing
here needs a window or watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.filters import split_by
from ..schemas import MANIFEST


def read_manifest_stream(spark: SparkSession, path: str, schema: T.StructType = MANIFEST) -> DataFrame:
    return spark.readStream.schema(schema).json(path)


def start_manifest_filter(
    manifest: DataFrame, reason: Column, path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Append kept rows as JSON lines; each input row is written exactly once across restarts."""
    kept = split_by(manifest, reason).kept
    writer = kept.writeStream.format("json").option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start(path)
