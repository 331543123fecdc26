"""Manifests out of plain text lines: naive CSV, sanity-check reports, subtitle files, text files, id lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import is_number, py_round, to_number
from ..functions.paths import base_name
from ..functions.text import BLANK, MANIFEST_PUNCTUATION, space_scripts, strip_punct
from ..operators.filters import Split, band_reason, first_reason, marker_reason, reason_if
from ..schemas import SUBTITLE

# Lines of a text file that hold one of these are mail headers.
HEADER_MARKS = ("Subject:", "From:", "Date:", "To:")
# Address of a video page, and the layouts of both report lines.
WATCH_URL = "https://www.youtube.com/watch?v="


def manifest_from_csv(
    lines: DataFrame, min_s: float = 1.0, max_s: float = 30.0, root: str = "waves/", marker: str = "[UNK]", col: str = "value"
) -> Split:
    """Lines ``path,text,duration`` cut at every comma; the path is cut after the last ``root``.

    A comma inside the text shifts the fields, so lines whose third field is no number are refused.
    """
    fields = F.split(F.col(col), ",", -1)
    duration = F.get(fields, F.lit(2))
    rows = lines.select(
        *[c for c in lines.columns if c != col],
        F.substring_index(F.get(fields, F.lit(0)), root, -1).alias("audio_filepath"),
        to_number(duration).alias("duration"),
        F.get(fields, F.lit(1)).alias("text"),
        reason_if(~is_number(duration), "bad_duration").alias("_bad"),
    )
    reason = first_reason(F.col("_bad"), band_reason(F.col("duration"), min_s, max_s), marker_reason(F.col("text"), marker))
    tagged = rows.withColumn("reason", reason).drop("_bad")
    kept = tagged.filter("reason IS NULL").drop("reason").withColumn("duration", py_round(F.col("duration"), 2))
    return Split(kept, tagged.filter("reason IS NOT NULL"))


_CER_LINE = r"^(.*?): \{'cer': ([^}]*)\} ref:(.*?) : pred:(.*)$"
_WER_LINE = r"^AUDIO FILENAME: (.*?) \|  WER RATE: ([^ |]*) \|.*?  gt text: (.*?) \|  pred text: (.*)$"


def parse_sanity_lines(lines: DataFrame, col: str = "value") -> Split:
    """Both report layouts as (audio_filepath, metric, rate, ref, hyp); lines of neither layout are refused."""
    line = F.col(col)
    is_cer, is_wer = line.rlike(_CER_LINE), line.rlike(_WER_LINE)

    def part(group: int) -> Column:
        return F.when(is_cer, F.regexp_extract(line, _CER_LINE, group)).when(is_wer, F.regexp_extract(line, _WER_LINE, group))

    rest = [c for c in lines.columns if c != col]
    parsed = lines.select(
        *rest,
        part(1).alias("audio_filepath"),
        F.when(is_cer, "cer").when(is_wer, "wer").alias("metric"),
        to_number(part(2)).alias("rate"),
        part(3).alias("ref"),
        part(4).alias("hyp"),
        line.alias("line"),
    )
    good = F.col("rate").isNotNull()
    rejects = parsed.filter(~good).select(*rest, "line", F.lit("unparsed").alias("reason"))
    return Split(parsed.filter(good).drop("line"), rejects)


def sanity_manifest(parsed: DataFrame, clean: bool = False) -> DataFrame:
    """Manifest of the checked files; ``clean`` writes the punctuation-free, spaced text instead of the raw one."""
    text = F.col("ref")
    if clean:
        text = space_scripts(strip_punct(text, MANIFEST_PUNCTUATION, {}))
    return parsed.select("audio_filepath", text.alias("text"))


def parse_subtitles(lines: DataFrame, col: str = "value", path: str = "path") -> Split:
    """Subtitle files, one dictionary per line with a comma after it; the video id is the file's stem.

    Lines that are no such dictionary are rejects.
    """
    options = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
    record = F.from_json(F.regexp_replace(F.col(col), r",\s*$", ""), SUBTITLE, options)
    rest = [c for c in lines.columns if c not in (col, path)]
    parsed = lines.select(
        *rest, F.regexp_replace(base_name(F.col(path)), r"\.[^.]*$", "").alias("video_id"), record.alias("_r"), F.col(col).alias("line")
    )
    kept = parsed.filter("_r.start IS NOT NULL").select(*rest, "video_id", "_r.text", "_r.start", "_r.duration")
    return Split(kept, parsed.filter("_r.start IS NULL").select(*rest, "video_id", "line", F.lit("unparsed").alias("reason")))


def clean_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines of a text file without trailing blanks, empty lines, mail headers and one-word lines."""
    cut = lines.withColumn(col, F.regexp_replace(F.col(col), BLANK + "+$", ""))
    headers = F.col(col).rlike("|".join(HEADER_MARKS))
    return cut.filter((F.col(col) != "") & ~headers & (F.size(F.split(F.col(col), " ", -1)) > 1))


def urls_from_ids(df: DataFrame, col: str = "id", prefix: str = WATCH_URL) -> DataFrame:
    return df.withColumn("url", F.concat(F.lit(prefix), F.col(col)))
