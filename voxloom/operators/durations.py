"""Duration totals and offenders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import py_round


def duration_report(df: DataFrame, col: str = "duration", lo: float = 1.0, hi: float = 30.0) -> DataFrame:
    """Total seconds and hours with counts of empty, long and short files; an empty file is also short."""
    d = F.col(col)
    return df.agg(
        py_round(F.sum(d), 2).alias("total_s"),
        py_round(F.sum(d) / 3600, 2).alias("total_h"),
        F.count_if(d == 0).alias("n_empty"),
        F.count_if(d > hi).alias("n_long"),
        F.count_if(d < lo).alias("n_short"),
    )


def total_hours(df: DataFrame, col: str = "duration") -> DataFrame:
    return df.agg(F.sum(col).alias("total_s"), (F.sum(col) / 3600).alias("total_h"))


def duration_issues(
    df: DataFrame, path: str = "audio_filepath", col: str = "duration", lo: float = 1.0, hi: float = 30.0
) -> DataFrame:
    """One row per file and issue."""
    d = F.col(col)
    tags = F.array(F.when(d == 0, "empty"), F.when(d > hi, "long"), F.when(d < lo, "short"))
    return df.select(path, col, F.explode(F.array_compact(tags)).alias("issue"))
