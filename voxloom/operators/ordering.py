"""Order-dependent helpers that never gather a large group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A window partition of ``dense_index`` covers at most 2^18 consecutive ids. Their sizes are summed in
# windows of at most 2^23 small rows, a number met only when ids are spread over all 64 bits.
_ROW_BITS = 18
_LEVEL_BITS = 23


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi-join on columns of both sides where null meets null; the key columns are those of ``left``."""
    names = {key: f"_right_{n}" for n, key in enumerate(keys)}
    on = reduce(and_, [F.col(key).eqNullSafe(F.col(name)) for key, name in names.items()])
    return left.join(right.withColumnsRenamed(names), on, how).drop(*names.values())


def dense_index(
    df: DataFrame,
    order: str = "row_id",
    group: Sequence[str] = (),
    name: str = "idx",
    row_bits: int = _ROW_BITS,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Number rows 0, 1, 2, … by an integer column, within each group or overall; ``ties`` order equal ids.

    Ids are cut into ranges of fixed width, so a range holds a bounded number of rows whatever the data
    looks like and however large a group is. Rows are numbered inside their range and shifted by the
    number of rows in earlier ranges; those totals are summed level by level in the same way.

    Every row gets a number: a null group is a group, and null ids come first. Ids should be unique within a
    group, null ids few: equal ones share a range.
    """
    group = list(group)
    bucket = [f"_b{k}" for k in range(4)]
    shifts = [row_bits + _LEVEL_BITS * k for k in range(4) if row_bits + _LEVEL_BITS * k < 63]
    levels = bucket[: len(shifts)]
    keyed = df.withColumn(levels[0], F.shiftright(F.col(order).cast("bigint"), shifts[0]))
    sizes = keyed.groupBy(*group, levels[0]).agg(F.count("*").alias("_n"))
    tables = [sizes]
    for below, level in zip(levels, levels[1:]):
        sizes = tables[-1].withColumn(level, F.shiftright(below, _LEVEL_BITS))
        tables[-1] = sizes
        tables.append(sizes.groupBy(*group, level).agg(F.sum("_n").alias("_n")))
    before = None
    for k in range(len(levels) - 1, -1, -1):
        parent = [levels[k + 1]] if k + 1 < len(levels) else []
        earlier = Window.partitionBy(*group, *parent).orderBy(levels[k]).rowsBetween(Window.unboundedPreceding, -1)
        shifted = tables[k].withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        if before is not None:
            shifted = null_safe_join(shifted, before, group + parent).withColumn("_before", F.col("_before") + F.col("_above"))
        before = shifted.select(*group, levels[k], F.col("_before").alias("_above"))
    inside = F.row_number().over(Window.partitionBy(*group, levels[0]).orderBy(order, *ties))
    numbered = null_safe_join(keyed.withColumn("_at", inside), before, group + [levels[0]])
    return numbered.withColumn(name, F.col("_above") + F.col("_at") - 1).select(*df.columns, name)


def salt(df: DataFrame, salts: int) -> Column:
    """A number below ``salts`` per row, the same again when a lost task is rerun.

    The partition number keeps exact copies of one row, which hash alike, from all drawing the same salt.
    """
    return F.pmod(F.xxhash64(*df.columns).bitwiseXOR(F.spark_partition_id().cast("bigint")), F.lit(salts)).cast("int")


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int, salts: int = 64
) -> DataFrame:
    """The first ``k`` rows of each group.

    Spark cuts groups to ``k`` rows per task before the shuffle; a group met in every task still brings
    ``k`` rows from each, so a first round shares it among ``salts`` tasks. All rows of one task have the same
    salt, so no more than ``k`` of a group leave it.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    part = Window.partitionBy(*keys, "_salt").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .withColumn("_rank", F.row_number().over(part))
        .filter(F.col("_rank") <= k)
        .withColumn("_rank", F.row_number().over(whole))
        .filter(F.col("_rank") <= k)
        .drop("_salt", "_rank")
    )


def first_n(df: DataFrame, order: str = "row_id", n: int = 20) -> DataFrame:
    """The first rows in input order, kept as a bounded heap per task."""
    return df.orderBy(order).limit(n)


def skew_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    salts: int = 32,
    share: int = 1000,
    least: int = 100_000,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join rows with a derived table of one row per key when a few keys may hold most rows. Null meets null.

    Adaptive execution splits skewed partitions only where both sides come straight from a shuffle; a table
    made by an aggregate does not. Keys holding more than 1/``share`` of all rows (so fewer than ``share``
    keys, safe to broadcast) and more than ``least`` rows are spread over ``salts`` partitions, and their
    lookup row is repeated. ``counts``, the keys with the number of their rows as ``_n``, saves counting them again.
    """
    keys = list(keys)
    if counts is None:
        counts = big.groupBy(*keys).agg(F.count("*").alias("_n"))
    bar = F.greatest(F.lit(least), counts.agg(F.sum("_n")).scalar() / share)
    hot = F.broadcast(counts.filter(F.col("_n") > bar).select(*keys, F.lit(True).alias("_hot")))
    spread = F.when(F.col("_hot"), salt(big, salts)).otherwise(0)
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = null_safe_join(big, hot, keys, "left").withColumn("_salt", spread).drop("_hot")
    right = null_safe_join(lookup, hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return null_safe_join(left, right, keys + ["_salt"], how).drop("_salt")
