"""Shared folder, written intermediate tables, and memory that outlives a task."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Sequence
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

T = TypeVar("T")

# A word: a run of anything but the six ASCII blanks. The same pattern in Java, Python and SQL.
WORD = r"[^\x20\x09-\x0D]+"


def settle(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder and read back: lineage is cut and a lost executor loses nothing."""
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_memo(name: str, make: Callable[[], T]) -> T:
    """``make()``, once per Python worker. Functions are shipped by value, so their globals end with the task."""
    memo = sys.__dict__.setdefault("_voxloom_memo", {})
    if name not in memo:
        memo[name] = make()
    return memo[name]


def give_back() -> None:
    """Hand freed memory back to the system. Workers are used again by later stages, and would keep what a task once took."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        # Not this C library; what pyarrow has released is all then.
        pass


def hash60(c: Column) -> Column:
    """The first 60 bits of the MD5 of a string, as a number that SQL engines agree on."""
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("bigint")


# Rows of an Arrow batch at most. Texts are long, and batches are held whole on both sides of the way to Python.
BATCH_ROWS = 1_000
BATCH_BYTES = 16 << 20
_BATCH_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's rows and bytes per Arrow batch to these limits if they are more; results do not depend on it."""
    for name, limit in _BATCH_LIMITS.items():
        # A size with a unit, or none at all, is taken for too much.
        now = spark.conf.get(name).lower().removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= limit:
            spark.conf.set(name, str(limit))


def carry(df: DataFrame, keep: Sequence[str], text: str) -> tuple[DataFrame, int]:
    """The columns ``keep`` and the text, and the place of the text among them; it is sent to Python only once."""
    bound_batches(df.sparkSession)
    if text in keep and df.schema[text].dataType.simpleString() == "string":
        return df.select(*keep), list(keep).index(text)
    return df.select(*keep, df[text].cast("string").alias("_carried_text")), len(keep)


def whole_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))
