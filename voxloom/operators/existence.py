"""Manifest rows against a file listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import local_path, swap_ext
from ..functions.text import cut_at
from .dedupe import first_by
from .filters import Split


def _paths(listing: DataFrame, path: str) -> DataFrame:
    return listing.select(local_path(F.col(path)).alias("_path"))


def check_exists(manifest: DataFrame, listing: DataFrame, col: str = "audio_filepath", path: str = "path") -> Split:
    """Rows whose file is listed, and the missing ones."""
    on = local_path(manifest[col]) == F.col("_path")
    missing = manifest.join(_paths(listing, path), on, "left_anti")
    return Split(
        manifest.join(_paths(listing, path), on, "left_semi"), missing.withColumn("reason", F.lit("missing_file"))
    )


def exist_counts(manifest: DataFrame, listing: DataFrame, col: str = "audio_filepath", path: str = "path") -> DataFrame:
    """Rows with and without their file, counted per distinct path before the join."""
    rows = manifest.groupBy(local_path(F.col(col)).alias("_path")).agg(F.count("*").alias("n"))
    found = _paths(listing, path).distinct().withColumn("found", F.lit(True))
    present = F.coalesce("found", F.lit(False))
    return rows.join(found, "_path", "left").agg(
        F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("present"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("missing"),
    )


def keep_listed(df: DataFrame, listing: DataFrame, key: str, path: str = "path") -> DataFrame:
    """Rows whose computed file name is in the listing."""
    return df.join(listing.select(F.col(path).alias(key)), key, "left_semi")


def manifest_from_tsv(df: DataFrame, listing: DataFrame, order: str = "row_id") -> DataFrame:
    """Listed clips of a path/sentence table, first row per clip, text cut at the full-width bracket."""
    named = df.withColumn("audio_filepath", swap_ext(F.col("path"), ".mp3", ".wav"))
    listed = keep_listed(named.drop("path"), listing, "audio_filepath")
    kept = first_by(listed, "audio_filepath", order)
    return kept.select("audio_filepath", cut_at(F.col("sentence")).alias("text"))
