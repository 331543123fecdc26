"""Praat TextGrid files to manifest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import py_round
from ..functions.paths import base_name, encode_segment, local_path, name_parts_ne
from ..functions.wav import let
from ..operators.filters import Split, band_reason, first_reason

# Only interval tiers count: points have one time and make no segment.
_INTERVAL = r'intervals \[\d+\]:\s*xmin = ([-+.\deE]+)\s*xmax = ([-+.\deE]+)\s*text = "([^"]*+(?:""[^"]*+)*+)"'


# What counts in the short layout: quoted texts, numbers that stand alone, and the flag that tiers follow.
_TOKEN = r'("[^"]*+(?:""[^"]*+)*+"|(?<!\S)[-+]?[0-9.][-+.0-9eE]*(?!\S)|<exists>|<absent>)'


def read_textgrids(spark: SparkSession, path: str, glob: str = "*TextGrid") -> DataFrame:
    """One row per file; a file is read whole because its tiers cross lines. UTF-16 is known by its mark, all else is UTF-8."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select(local_path(F.col("path")).alias("path"), text_of(F.col("content")).alias("value"))


def text_of(content: Column) -> Column:
    """The text of a file in UTF-8, or in UTF-16 of either order if it begins with the mark of one; marks are dropped."""
    mark = F.hex(F.substring(content, 1, 2))
    wide = mark.isin("FEFF", "FFFE") & (F.octet_length(content) % 2 == 0)
    plain = content.cast("string")
    return F.when(wide, F.decode(F.when(wide, content), "UTF-16")).otherwise(F.regexp_replace(plain, "^\ufeff", ""))


def _short_marks(value: Column) -> Column:
    """Intervals of the short layout, where values stand without labels: null unless the values are as many as they say.

    After class, name, times and size of a tier come its items, three values an interval and two a point. A fold over the
    tiers finds where each begins, so texts that look like a header are no matter; items are cut out by position.
    """

    def tiers_of(t: Column) -> Column:
        def number(at: Column) -> Column:
            return F.get(t, at).try_cast("double")

        start = F.struct(F.lit(6).alias("at"), F.lit(True).alias("good"), F.array().cast("array<struct<first:int,n:int>>").alias("found"))

        def step(acc: Column, _: Column) -> Column:
            kind, n = F.get(t, acc["at"]), number(acc["at"] + 4).cast("int")
            wide = F.when(kind == '"IntervalTier"', 3).when(kind == '"TextTier"', 2)
            good = acc["good"] & F.coalesce((n >= 0) & (wide > 0), F.lit(False))
            end = acc["at"] + 5 + F.when(good, n * wide).otherwise(0)
            tier = F.when(good & (wide == 3), F.array(F.struct((acc["at"] + 5).alias("first"), n.alias("n")))).otherwise(F.array().cast("array<struct<first:int,n:int>>"))
            return F.struct(end.alias("at"), (good & (end <= F.size(t))).alias("good"), F.concat(acc["found"], tier).alias("found"))

        many = F.least(number(F.lit(5)).cast("int"), F.size(t))
        steps = F.when(many > 0, F.sequence(F.lit(1), many)).otherwise(F.array().cast("array<int>"))
        head = F.coalesce((F.get(t, F.lit(0)) == '"ooTextFile"') & (F.get(t, F.lit(1)) == '"TextGrid"') & (F.get(t, F.lit(4)) == "<exists>") & (many >= 0), F.lit(False))
        items = lambda tier: F.transform(
            F.when(tier["n"] > 0, F.sequence(F.lit(0), tier["n"] - 1)).otherwise(F.array().cast("array<int>")),
            lambda k: F.struct(
                F.get(t, tier["first"] + 3 * k).alias("lo"),
                F.get(t, tier["first"] + 3 * k + 1).alias("hi"),
                F.regexp_replace(F.get(t, tier["first"] + 3 * k + 2), '^"|"$', "").alias("mark"),
            ),
        )
        return let(F.aggregate(steps, start, step), lambda acc: F.when(head & acc["good"], F.flatten(F.transform(acc["found"], items))))

    return let(F.regexp_extract_all(value, F.lit(_TOKEN), F.lit(1)), tiers_of)


def manifest_from_textgrid(files: DataFrame, min_s: float = 0.3, max_s: float = 30.0) -> Split:
    """One row per interval with a mark, named after file and times; the band is judged before rounding.

    Files may be in the long layout, with labels, or in the short one. Points are passed over. Files whose base name has
    exactly two parts are left out. Files in another layout, or of fewer values than they say, are refused, as are
    intervals outside the band.
    """
    wanted = files.filter(name_parts_ne(F.col("path"), 2))
    value = F.col("value")
    known = value.contains("ooTextFile")
    labelled = known & value.rlike(r"item \[\]:")
    short = F.when(known & ~labelled, _short_marks(value))
    readable = labelled | short.isNotNull()
    numbers = [F.regexp_extract_all(value, F.lit(_INTERVAL), F.lit(k)) for k in (1, 2, 3)]
    marks = F.when(labelled, F.arrays_zip(*[n.alias(a) for n, a in zip(numbers, ("lo", "hi", "mark"))])).otherwise(short)
    rows = wanted.select(
        "path",
        F.substring_index(base_name(F.col("path")), ".TextGrid", 1).alias("base"),
        F.coalesce(readable, F.lit(False)).alias("readable"),
        F.posexplode_outer(marks).alias("pos", "i"),
    )
    timed = rows.select(
        "path",
        "base",
        "pos",
        "readable",
        F.col("i")["lo"].try_cast("double").alias("lo"),
        F.col("i")["hi"].try_cast("double").alias("hi"),
        F.replace(F.col("i")["mark"], F.lit('""'), F.lit('"')).alias("text"),
    ).filter("NOT readable OR (text IS NOT NULL AND text <> '')")
    length = F.col("hi") - F.col("lo")
    reason = first_reason(F.when(~F.col("readable"), "unreadable_file"), band_reason(length, min_s, max_s))
    tagged = timed.select(
        "path",
        "pos",
        encode_segment(F.col("base"), F.col("lo"), F.col("hi")).alias("audio_filepath"),
        py_round(length, 2).alias("duration"),
        "text",
        reason.alias("reason"),
    )
    return Split(tagged.filter("reason IS NULL").drop("reason"), tagged.filter("reason IS NOT NULL"))
