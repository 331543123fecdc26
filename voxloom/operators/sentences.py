"""Sentences of longer texts that hold keywords, and the spoken-form test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import sentences, strip_tags
from .keywords import keyword_matches


def keyword_sentences(df: DataFrame, keywords: Sequence[str], keep: Sequence[str], col: str = "text") -> DataFrame:
    """Each sentence with each keyword it contains."""
    split = df.select(*keep, F.posexplode(sentences(F.col(col))).alias("sentence_no", "sentence"))
    return keyword_matches(split, keywords, "sentence")


def page_sentences(df: DataFrame, keywords: Sequence[str], keep: Sequence[str], col: str = "html") -> DataFrame:
    """The same for web pages, on their visible text."""
    return keyword_sentences(df.select(*keep, strip_tags(F.col(col)).alias("text")), keywords, keep)


def marker_hits(c: Column, markers: Sequence[str]) -> Column:
    """Occurrences of all markers in a text."""
    total = F.lit(0)
    for marker in markers:
        removed = F.replace(c, F.lit(marker), F.lit(""))
        total = total + ((F.length(c) - F.length(removed)) / len(marker)).cast("int")
    return total


def spoken_form(df: DataFrame, spoken: Sequence[str], written: Sequence[str], col: str = "text") -> DataFrame:
    """Keep texts with at least as many spoken-form markers as written-form ones."""
    return df.filter(marker_hits(F.col(col), spoken) >= marker_hits(F.col(col), written))
