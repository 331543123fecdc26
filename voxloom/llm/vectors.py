"""Vectors as columns and as packed bytes, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Integers beyond this are no longer exact in doubles; larger components stay here.
EXACT = 1 << 52


def sound(c: Column) -> Column:
    """Whether a vector is there, has components, and all of them are there and finite."""
    finite = F.forall(c, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & finite, F.lit(False))


def floors(c: Column, scale: int, shift: int = 0) -> Column:
    """floor(scale * x) + shift of every component as a double, held within 52 bits."""
    top = float(EXACT)
    return F.transform(c, lambda x: F.least(F.greatest(F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-top)), F.lit(top))).cast("double"), F.lit(-top)), F.lit(top)) + shift)


def common_width(df: DataFrame, vector: str) -> int:
    """The commonest length of the column's vectors, the greater of two as common; 0 without rows."""
    first = df.groupBy(F.size(vector).alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    return first["w"] if first else 0


def one_per_key(df: DataFrame, key: str, *values: str) -> DataFrame:
    """One row of each key: the least by ``values`` in their order. Rows combine before they are shuffled."""
    return df.groupBy(key).agg(F.min(F.struct(*values)).alias("_least")).select(key, "_least.*")


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all of one length, as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
