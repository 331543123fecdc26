"""File-name expressions: base names, extensions, ids, segment names, natural order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import py_round

SEGMENT_MARK = "_0000_"
_SEGMENT = r"^(.*?)_0000_([^_]+)_([^_]+)\.wav$"
_BRACKET_ID = r"\[([^\[\]]+)\]\.wav$"


def base_name(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def local_path(c: Column) -> Column:
    """Drop the ``file:`` scheme that file sources put in front of local paths."""
    return F.regexp_replace(c, r"^file:/+", "/")


def has_extension(c: Column, ext: str) -> Column:
    return F.substring_index(c, ".", -1) == F.lit(ext.lstrip("."))


def swap_ext(c: Column, old: str, new: str) -> Column:
    """Everything before the first ``old``, then ``new``."""
    return F.concat(F.substring_index(c, old, 1), F.lit(new))


def name_parts_ne(c: Column, n: int, sep: str = "_") -> Column:
    """True unless the base name has exactly ``n`` parts."""
    return F.size(F.split(base_name(c), sep, -1)) != n


def bracket_id(c: Column) -> Column:
    """The id in ``title [id].wav``; null for names of another shape."""
    return F.nullif(F.regexp_extract(c, _BRACKET_ID, 1), F.lit(""))


def seconds_text(c: Column) -> Column:
    """Seconds with at most two decimals and at least one, as in ``0.2`` and ``2.0``."""
    return F.regexp_replace(py_round(c, 2).cast("decimal(20,2)").cast("string"), r"(\.\d)0$", "$1")


def encode_segment(base: Column, start: Column, end: Column) -> Column:
    return F.concat(base, F.lit(SEGMENT_MARK), seconds_text(start), F.lit("_"), seconds_text(end), F.lit(".wav"))


def decode_segment(c: Column) -> Column:
    """Struct of source recording, start and end; its fields are null for other names."""
    hit = c.rlike(_SEGMENT)
    return F.struct(
        F.when(hit, F.concat(F.regexp_extract(c, _SEGMENT, 1), F.lit(".wav"))).alias("source"),
        F.when(hit, F.regexp_extract(c, _SEGMENT, 2).try_cast("double")).alias("start_time"),
        F.when(hit, F.regexp_extract(c, _SEGMENT, 3).try_cast("double")).alias("end_time"),
    )


def route_paths(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Move paths holding a marker under that marker's root; the first rule that fits wins."""
    routed = None
    for marker, root in rules:
        target = F.concat(F.lit(root), base_name(c))
        hit = F.contains(c, F.lit(marker))
        routed = F.when(hit, target) if routed is None else routed.when(hit, target)
    return c if routed is None else routed.otherwise(c)


def natural_key(c: Column) -> Column:
    """Sort key that orders digit runs by value: text and number pieces in turn, text first.

    A number is its digits without leading zeros, compared by their count before themselves, so runs of any
    length keep their order.
    """
    pieces = F.regexp_extract_all(c, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))

    def part(x: Column) -> Column:
        digits = F.when(x.rlike("^[0-9]"), F.regexp_replace(x, "^0+", ""))
        text = F.when(digits.isNull(), x).otherwise("")
        return F.struct(
            text.alias("text"), F.coalesce(F.length(digits), F.lit(0)).alias("size"), F.coalesce(digits, F.lit("")).alias("digits")
        )

    empty = F.array(F.struct(F.lit("").alias("text"), F.lit(0).alias("size"), F.lit("").alias("digits")))
    parts = F.transform(pieces, part)
    return F.when(c.rlike("^[0-9]"), F.concat(empty, parts)).otherwise(parts)
