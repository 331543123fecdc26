"""Subtitle language fallback and segment-count filters over exploded tracks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedupe import first_by
from .ordering import skew_join

# Subtitle languages in the order they are tried.
LANGUAGES = ("zh-CN", "zh", "zh-Hant", "zh-TW", "zh-Hans", "zh-HK")


def first_language(tracks: DataFrame, priority: Sequence[str] = LANGUAGES, key: str = "id", lang: str = "lang") -> DataFrame:
    """One track per id, in the first language of the list that exists; ids without one are left out."""
    rank = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col(lang))
    ranked = tracks.withColumn("_priority", rank).filter(F.col("_priority") > 0)
    return first_by(ranked, key, ["_priority"]).drop("_priority")


def tracks_with_segments(segments: DataFrame, key: str = "id", n: int = 2) -> DataFrame:
    """Segment rows of the tracks that have at least ``n`` of them; rows without a track id count as one track."""
    counts = segments.groupBy(key).agg(F.count("*").alias("_n"))
    return skew_join(segments, counts.filter(F.col("_n") >= n).select(key), [key], counts=counts)
