"""Duplicates: first row per key, duplicate counts, used names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import base_name, bracket_id
from .ordering import skew_join


def first_by(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str | Column] = "row_id") -> DataFrame:
    """The first row of each key in input order.

    The rank limit also runs ahead of the shuffle, so copies of a hot key leave each task as one row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, (str, Column)) else list(order)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*orders))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def first_by_text(df: DataFrame, text: str = "text", order: str | Sequence[str | Column] = "row_id") -> DataFrame:
    """The first row of each text. Rows are dealt and sorted by a digest, not by their texts; null texts are one text."""
    return first_by(df.withColumn("_digest", row_digest(text)), "_digest", order).drop("_digest")


def row_digest(*cols: str) -> Column:
    """256-bit digest of whole rows, so that equal rows meet without moving their text."""
    parts = [F.coalesce(F.concat(F.length(c), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in cols]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows equal to an earlier row."""
    copies = df.groupBy(row_digest(*df.columns).alias("digest")).agg(F.count("*").alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def used_names(df: DataFrame, col: str = "audio_filepath") -> DataFrame:
    """Each base name with the number of rows that use it."""
    return df.groupBy(base_name(F.col(col)).alias("base_name")).agg(F.count("*").alias("n"))


def duplicate_names(df: DataFrame, col: str = "audio_filepath") -> DataFrame:
    """Number of rows whose base name occurred before."""
    return used_names(df, col).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_names"), F.count("*").alias("distinct_names")
    )


def rename_plan(df: DataFrame, col: str = "path") -> DataFrame:
    """Old and new name for ``title [id].wav`` files; a target claimed twice is marked, as a move would overwrite."""
    named = df.select(F.col(col).alias("source"), bracket_id(F.col(col)).alias("id")).filter("id IS NOT NULL")
    folder = F.regexp_replace("source", "[^/]*$", "")
    plan = named.select("source", F.concat(folder, "id", F.lit(".wav")).alias("target"))
    claims = plan.groupBy("target").agg(F.count("*").alias("claims"))
    counts = claims.withColumnRenamed("claims", "_n")
    return skew_join(plan, claims, ["target"], counts=counts).select("source", "target", (F.col("claims") > 1).alias("collision"))
