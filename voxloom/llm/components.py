"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle


def _mark(edges: DataFrame) -> tuple:
    """Tells two edge sets apart: their number and the sum of a hash."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node with an edge to another: the smallest node it can reach.

    Every round is written to the shared folder, and only its count and checksum come to the driver. A star finds its
    smallest node in a window, which spills where a star is large; no list of neighbours is built, and a round
    shuffles three times.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    e, seen = settle(e), None
    least = F.min("v").over(Window.partitionBy("u"))
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Every larger neighbour goes to the smallest node around; repeated edges are dropped together with others below.
        large = both.withColumn("m", F.least("u", least)).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Every neighbour, all smaller now, and the node itself go to the smallest of them.
        small = large.withColumn("m", least)
        ends = F.array(F.when(F.col("v") > F.col("m"), F.col("v")), F.col("u"))
        small = small.select(F.explode(ends).alias("u"), F.col("m").alias("v")).filter("u IS NOT NULL")
        e = settle(small.distinct())
        now = _mark(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
