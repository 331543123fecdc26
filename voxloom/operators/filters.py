"""Row filters. Each names why a row is refused, so kept rows, rejects and counts come from one column.

A filter returns ``Split(kept, rejects)``; rejects carry ``reason``. Reasons are plain column expressions,
so they also run on streams, and several can be chained with ``first_reason`` to judge a row in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPECIAL_CHARACTERS, has_any_char
from ..schemas import MANIFEST_COLUMNS


class Split(NamedTuple):
    kept: DataFrame
    rejects: DataFrame


def split_by(df: DataFrame, reason: Column, keep: Column | None = None) -> Split:
    """Kept rows have no reason. ``keep`` may state a condition every kept row meets in plain comparisons,
    which, other than a reason, can be pushed into the scan."""
    kept = df if keep is None else df.filter(keep)
    tagged = df.withColumn("reason", reason)
    return Split(kept.filter(reason.isNull()), tagged.filter("reason IS NOT NULL"))


def reason_if(condition: Column, reason: str) -> Column:
    """``reason`` where the condition holds; an unknown condition refuses the row too."""
    return F.when(F.coalesce(condition, F.lit(True)), F.lit(reason))


def user_reason(accept: Callable[..., pd.Series], *columns: str, reason: str = "user") -> Column:
    """``reason`` where a function of the user's own does not accept the row.

    ``accept`` gets the columns as pandas Series, an Arrow batch at a time, and returns a Series of booleans; a missing one
    refuses the row. Its answer must depend on the row alone, as batches are cut anywhere.
    """
    # Wrapped, so that type hints of ``accept`` do not decide what kind of function Spark takes it for.
    judge = F.pandas_udf(lambda *series: accept(*series), "boolean")
    return reason_if(~judge(*columns), reason)


def first_reason(*reasons: Column) -> Column:
    return F.coalesce(*reasons)


def reason_counts(df: DataFrame, reason: Column) -> DataFrame:
    """Rows kept and refused, by reason."""
    return df.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def band_reason(
    c: Column, lo: float, hi: float, inclusive: bool = True, applies: Column | None = None
) -> Column:
    """``long`` or ``short`` outside the band; bounds belong to the band when ``inclusive``."""
    long = c > hi if inclusive else c >= hi
    short = c < lo if inclusive else c <= lo
    reason = F.when(c.isNull(), "no_duration").when(long, "long").when(short, "short")
    return reason if applies is None else F.when(applies, reason)


def inside_band(c: Column, lo: float, hi: float, inclusive: bool = True) -> Column:
    return (c >= lo) & (c <= hi) if inclusive else (c > lo) & (c < hi)


def duration_band(
    df: DataFrame, col: str, lo: float, hi: float, inclusive: bool = True, split: str | None = None
) -> Split:
    applies = None if split is None else F.col("split") == split
    keep = inside_band(F.col(col), lo, hi, inclusive) if split is None else None
    return split_by(df, band_reason(F.col(col), lo, hi, inclusive, applies), keep)


def marker_reason(c: Column, marker: str = "[UNK]") -> Column:
    return reason_if(F.contains(c, F.lit(marker)), "marker")


def drop_marker(df: DataFrame, col: str = "text", marker: str = "[UNK]") -> Split:
    return split_by(df, marker_reason(F.col(col), marker))


def special_reason(c: Column, chars: str = SPECIAL_CHARACTERS) -> Column:
    return reason_if(has_any_char(c, chars), "special_character")


def drop_special_chars(df: DataFrame, col: str = "text", chars: str = SPECIAL_CHARACTERS) -> Split:
    return split_by(df, special_reason(F.col(col), chars))


def blank_reason(c: Column, min_len: int = 1, ignore_blanks: bool = True) -> Column:
    """Text shorter than ``min_len`` characters, blanks not counted unless asked."""
    text = F.replace(c, F.lit(" "), F.lit("")) if ignore_blanks else c
    return reason_if(F.length(text) < min_len, "blank")


def drop_blank(df: DataFrame, col: str = "text", min_len: int = 1, ignore_blanks: bool = True) -> Split:
    return split_by(df, blank_reason(F.col(col), min_len, ignore_blanks))


def below_rate(df: DataFrame, metric: str, t: float = 0.5) -> Split:
    """Keep rows whose error rate is below ``t``; a missing rate is refused."""
    return split_by(df, reason_if(~(F.col(metric) < t), "error_rate"), F.col(metric) < t)


def below_length(df: DataFrame, col: str, n: int = 400, splits: Sequence[str] = ("train", "test")) -> Split:
    """Keep rows of ``splits`` whose length is below ``n``; other splits pass."""
    reason = F.when(F.col("split").isin(*splits), reason_if(~(F.col(col) < n), "label_length"))
    return split_by(df, reason, (F.col(col) < n) | ~F.col("split").isin(*splits) | F.col("split").isNull())


def split_empty_refs(df: DataFrame, col: str = "ref") -> Split:
    """Rows whose normalised reference has at most one character go to a report of their own."""
    return split_by(df, reason_if(F.length(F.trim(F.col(col))) <= 1, "empty_ref"))


def min_segments(df: DataFrame, col: str = "segments", n: int = 2) -> DataFrame:
    """Keep subtitle tracks with at least ``n`` segments."""
    return df.filter(F.size(col) >= n)


def to_manifest(df: DataFrame, **renames: str) -> DataFrame:
    """Manifest columns that exist, in manifest order; ``renames`` maps manifest name to source name."""
    sources = {name: renames.get(name, name) for name in MANIFEST_COLUMNS}
    return df.select(*[F.col(src).alias(name) for name, src in sources.items() if src in df.columns])
