"""Repeatable samples, shares, splits, shards and shuffles, all drawn from hashes of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import hash_rank, unit_hash
from .ordering import dense_index, skew_join, top_per_group

RATIOS = (("train", 0.8), ("test", 0.1), ("validation", 0.1))


def review_sample(df: DataFrame, strata: Sequence[str], n: int, key: str, seed: int = 0) -> DataFrame:
    """``n`` rows of each stratum, the same on every run."""
    return top_per_group(df, list(strata), [unit_hash(F.col(key), seed), key], n)


def epoch_shuffle(df: DataFrame, key: str, epoch: int) -> DataFrame:
    """A new order for each epoch, by a distributed sort."""
    return df.orderBy(hash_rank(F.col(key), epoch, "epoch"), key)


def epoch_places(df: DataFrame, key: str, epoch: int) -> DataFrame:
    """Add ``place``, the number of each row in the order of an epoch, without sorting all rows in one task."""
    ranked = df.withColumn("_order", hash_rank(F.col(key), epoch, "epoch"))
    return dense_index(ranked, "_order", name="place", row_bits=40, ties=[key]).drop("_order")


def split_column(key: Column, ratios: Sequence[tuple[str, float]] = RATIOS, seed: int = 0) -> Column:
    u, edge, names = unit_hash(key, seed), 0.0, None
    for name, share in ratios[:-1]:
        edge += share
        hit = u < F.lit(round(edge, 12))
        names = F.when(hit, name) if names is None else names.when(hit, name)
    last = F.lit(ratios[-1][0])
    return last if names is None else names.otherwise(last)


def split_sets(df: DataFrame, key: str, ratios: Sequence[tuple[str, float]] = RATIOS, seed: int = 0) -> DataFrame:
    """Add ``split``. Rows with equal keys stay together, so a speaker or recording as key never leaks."""
    return df.withColumn("split", split_column(F.col(key), ratios, seed))


def pick_share(df: DataFrame, key: str, share: float = 0.5, seed: int = 0) -> DataFrame:
    return df.filter(unit_hash(F.col(key), seed) < share)


def shard(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """Add ``shard``: n groups of about equal size, without moving a row."""
    return df.withColumn("shard", F.floor(unit_hash(F.col(key), seed) * n).cast("int"))


def equal_groups(df: DataFrame, n: int, order: str = "row_id") -> DataFrame:
    """Add ``shard``: n runs of consecutive rows whose sizes differ by at most one, larger ones first."""
    total = df.agg(F.count("*")).scalar()
    base, extra = F.floor(total / n), total % n
    cut = extra * (base + 1)
    at = F.col("idx")
    group = F.when(at < cut, F.floor(at / (base + 1))).otherwise(extra + F.floor((at - cut) / F.greatest(base, F.lit(1))))
    return dense_index(df, order).withColumn("shard", group.cast("int")).drop("idx")


# Ranges of the hash order of groups; their totals are added up in one window.
_WEIGHT_BITS = 14
# Shares are exact to a millionth.
_PARTS = 1_000_000


def weighted_places(df: DataFrame, key: str, weight: str, seed: int = 0, scale: int = 1000) -> DataFrame:
    """key, w, before and total: for each group its weight, that of the groups before it in an order drawn by hash, and of all.

    Weights are added in whole parts of 1/``scale``; null and negative ones count nothing. A null key is a group. Groups are added up inside
    ranges of the order, a small part of them each, and ranges among themselves, so no task meets all groups.
    """
    units = F.greatest(F.coalesce(F.round(F.col(weight).cast("double") * scale), F.lit(0.0)), F.lit(0.0)).cast("bigint")
    groups = df.groupBy(key).agg(F.sum(units.cast("decimal(38,0)")).alias("w")).withColumn("_order", hash_rank(F.col(key), seed, "weight"))
    groups = groups.withColumn("_range", F.shiftright("_order", 60 - _WEIGHT_BITS))
    ranges = groups.groupBy("_range").agg(F.sum("w").alias("_sum"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("decimal(38,0)")
    shifts = ranges.select("_range", F.coalesce(F.sum("_sum").over(earlier), none).alias("_above"), F.sum("_sum").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("_range").orderBy("_order", key).rowsBetween(Window.unboundedPreceding, -1)
    placed = groups.withColumn("_at", F.coalesce(F.sum("w").over(inside), none)).join(shifts, "_range")
    whole = [F.col(c).cast("decimal(38,0)").alias(n) for c, n in (("w", "w"), ("_at", "_at"), ("_above", "_above"), ("total", "total"))]
    return placed.select(key, *whole).select(key, "w", (F.col("_at") + F.col("_above")).cast("decimal(38,0)").alias("before"), "total")


def weighted_split(df: DataFrame, key: str, weight: str, ratios: Sequence[tuple[str, float]] = RATIOS, seed: int = 0, scale: int = 1000) -> DataFrame:
    """Add ``split`` so that splits have their share of the weight, such as hours, and a group, such as a speaker, is never divided.

    Groups stand in a row drawn by hash, as long as they weigh, which is cut at the shares; a group goes where its middle lies. So the
    weight of a split is off by half a group at either end, at most. Without any weight all groups go to the last split.
    """
    places = weighted_places(df, key, weight, seed, scale)
    middle = (F.col("before") * 2 + F.col("w")).cast("decimal(38,0)")
    total = (F.col("total") * 2).cast("decimal(38,0)")
    name, reached = None, 0.0
    for part, share in ratios[:-1]:
        reached += share
        # Both sides in doubles are off by far less than a part of a millionth of the total.
        hit = middle.cast("double") * _PARTS < total.cast("double") * round(reached * _PARTS)
        name = F.when(hit, part) if name is None else name.when(hit, part)
    named = F.lit(ratios[-1][0]) if name is None else name.otherwise(ratios[-1][0])
    return skew_join(df, places.select(key, named.alias("split")), [key])


def weighted_groups(df: DataFrame, n: int, key: str, weight: str, seed: int = 0, scale: int = 1000) -> DataFrame:
    """Add ``shard``: ``n`` groups of about equal weight, rows of one key together; see ``weighted_split``."""
    places = weighted_places(df, key, weight, seed, scale)
    share = (F.col("before") * 2 + F.col("w")).cast("double") * n / F.greatest(F.col("total").cast("double") * 2, F.lit(1.0))
    return skew_join(df, places.select(key, F.least(F.floor(share), F.lit(n - 1)).cast("int").alias("shard")), [key])


def with_variant(df: DataFrame, augmented: DataFrame) -> DataFrame:
    """Original and augmented rows in one frame, told apart by ``variant``."""
    return df.withColumn("variant", F.lit("original")).unionByName(
        augmented.withColumn("variant", F.lit("augmented")), allowMissingColumns=True
    )


def append_rows(df: DataFrame, extra: DataFrame, text: str | None = "…") -> DataFrame:
    """Add rows such as silence and noise; ``text`` becomes their transcript."""
    if text is not None:
        extra = extra.withColumn("text", F.lit(text))
    return df.unionByName(extra, allowMissingColumns=True)
