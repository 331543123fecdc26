"""Sanity check: does a second model roughly hear what the transcript says?"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_basic, words
from ..session import spread
from ..operators.filters import split_empty_refs
from ..operators.scoring import score_words


class Sanity(NamedTuple):
    scored: DataFrame
    accepted: DataFrame
    empty: DataFrame


def sanity_check(pairs: DataFrame, threshold: float = 0.5) -> Sanity:
    """``pairs`` holds audio_filepath, ref and hyp. Whole normalised texts are compared word by word.

    ``error`` is the unrounded word error rate and decides; references of one character or less are set apart.
    """
    normal = spread(pairs).select(
        "audio_filepath",
        F.trim(normalize_basic(F.col("ref"))).alias("ref"),
        F.trim(normalize_basic(F.col("hyp"))).alias("hyp"),
    )
    usable, empty = split_empty_refs(normal)
    worded = usable.withColumns({"ref_words": words(F.col("ref")), "hyp_words": words(F.col("hyp"))})
    errors = (F.col("sub") + F.col("ins") + F.col("del")).cast("double")
    scored = score_words(worded).withColumn("error", F.try_divide(errors, F.col("ref_len"))).drop("ref_words", "hyp_words")
    return Sanity(scored, scored.filter(F.col("error") < threshold), empty)
