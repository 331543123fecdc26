"""Training batches of label arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import dense_index

MASK = -100


def pad_batches(
    df: DataFrame, col: str, size: int, order: str = "row_id", pad: int = MASK, bos: int | None = None
) -> DataFrame:
    """Pad arrays to the longest of their batch of ``size`` consecutive rows.

    When every row of a batch starts with ``bos``, that first id is dropped from all of them.
    """
    batched = dense_index(df, order).withColumn("batch_id", F.floor(F.col("idx") / size)).drop("idx")
    batch = Window.partitionBy("batch_id")
    kind = dict(df.dtypes)[col].removeprefix("array<").removesuffix(">")
    gap = F.max(F.size(col)).over(batch) - F.size(col)
    padded = batched.withColumn(col, F.concat(col, F.array_repeat(F.lit(pad).cast(kind), gap)))
    if bos is None:
        return padded
    all_start = F.coalesce(F.every(F.get(F.col(col), F.lit(0)).eqNullSafe(F.lit(bos))).over(batch), F.lit(False))
    rest = F.slice(col, 2, F.greatest(F.size(col) - 1, F.lit(0)))
    return padded.withColumn("_cut", all_start).withColumn(col, F.when(F.col("_cut"), rest).otherwise(F.col(col))).drop("_cut")


def unmask(c: Column, pad: int, mask: int = MASK) -> Column:
    """Put the padding id back where labels were masked."""
    return F.transform(c, lambda x: F.when(x == mask, F.lit(pad)).otherwise(x))
