"""Cut segments out of recordings; audit and plan audio work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import base_name, decode_segment
from ..functions.wav import let, pcm_header, pcm_info
from .filters import Split


def segment_sources(segments: DataFrame, col: str = "audio_filepath") -> DataFrame:
    """Segment names with the recording and times they encode."""
    return segments.withColumn("_seg", decode_segment(base_name(F.col(col)))).select(
        *segments.columns, "_seg.source", F.col("_seg.start_time").alias("seg_start"), F.col("_seg.end_time").alias("seg_end")
    )


def cut_segments(segments: DataFrame, recordings: DataFrame, col: str = "audio_filepath") -> Split:
    """PCM bytes of each segment with a header of its own. Segments whose name tells no place, whose recording is
    missing or is no PCM file are rejects.

    Recordings are (path, content) as ``binaryFile`` reads them. Bytes are cut in the row where segment and
    recording meet, so whole recordings do not travel any further.
    """
    info = pcm_info(F.col("content"))
    tapes = recordings.select(base_name(F.col("path")).alias("source"), "content", info.alias("_info"), F.lit(True).alias("_there"))
    named = segment_sources(segments, col)
    placed = named.filter("source IS NOT NULL AND seg_start IS NOT NULL AND seg_end IS NOT NULL")
    met = placed.join(tapes.filter("_info IS NOT NULL"), "source")
    cut = met.withColumn("_cut", let(F.col("_info"), _cut)).select(*segments.columns, "source", "_cut.data_bytes", "_cut.content")
    # For the rejects only names and headers are read, no samples travel.
    known = tapes.select("source", "_there", F.col("_info").isNotNull().alias("_pcm"))
    lost = named.join(known, "source", "left").select(
        *segments.columns,
        F.when(F.col("source").isNull() | F.col("seg_start").isNull() | F.col("seg_end").isNull(), "bad_name")
        .when(F.col("_there").isNull(), "no_recording")
        .when(~F.col("_pcm"), "no_pcm_header")
        .alias("reason"),
    )
    return Split(cut, lost.filter("reason IS NOT NULL"))


def _cut(info: Column) -> Column:
    rate, align = info["sample_rate"], info["block_align"]
    frames = (info["data_bytes"] / align).cast("int")
    first = F.round(F.col("seg_start") * rate).cast("int")
    span = F.struct(first.alias("first"), F.least(F.round(F.col("seg_end") * rate).cast("int"), frames).alias("last"))

    def piece(s: Column) -> Column:
        n_bytes = F.greatest(s["last"] - s["first"], F.lit(0)) * align
        data = F.substring("content", (info["data_at"] + s["first"] * align).cast("int"), n_bytes.cast("int"))
        header = let(n_bytes, lambda n: pcm_header(n, rate, info["channels"], info["bits"]))
        return F.struct(n_bytes.alias("data_bytes"), F.concat(header, data).alias("content"))

    return let(span, piece)


def audit_format(df: DataFrame, rate: int = 16000, channels: int = 1, bits: int = 16) -> DataFrame:
    """Mark probed files that do not have the wanted rate, channels and sample width."""
    fits = (F.col("sample_rate") == rate) & (F.col("channels") == channels) & (F.col("bits") == bits)
    return df.withColumn("conforms", F.coalesce(fits, F.lit(False)))


def work_plan(df: DataFrame, op: str, root: str = "", col: str = "audio_filepath", suffix: str = ".wav") -> DataFrame:
    """What an outside tool has to do per file, as columns: operation, source, target, times.

    ``trim`` reads source and times from segment names; other operations map a file to ``root``/stem/suffix.
    """
    if op == "trim":
        planned = segment_sources(df.select(col), col).filter("source IS NOT NULL")
        return planned.select(
            F.lit(op).alias("op"),
            "source",
            F.concat(F.lit(root), base_name(F.col(col))).alias("target"),
            "seg_start",
            "seg_end",
        )
    stem = F.substring_index(base_name(F.col(col)), ".wav", 1)
    return df.select(
        F.lit(op).alias("op"),
        F.col(col).alias("source"),
        F.concat(F.lit(root), stem, F.lit(suffix)).alias("target"),
        F.lit(None).cast("double").alias("seg_start"),
        F.lit(None).cast("double").alias("seg_end"),
    )
