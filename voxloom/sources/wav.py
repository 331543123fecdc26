"""Probing WAV files from their headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import local_path
from ..functions.wav import pcm_info
from ..operators.filters import Split


def read_wavs(spark: SparkSession, path: str, glob: str = "*.wav") -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select(local_path(F.col("path")).alias("path"), "content")


def probe_wav(files: DataFrame) -> Split:
    """Format and seconds of each file; anything but PCM is refused, not guessed."""
    probed = files.select("path", pcm_info(F.col("content")).alias("_i"))
    known = probed.filter("_i IS NOT NULL").select(
        "path", "_i.channels", "_i.sample_rate", "_i.byte_rate", "_i.block_align", "_i.bits", "_i.data_bytes", F.try_divide(F.col("_i.data_bytes").cast("double"), F.col("_i.byte_rate")).alias("duration")
    )
    return Split(known, probed.filter("_i IS NULL").select("path", F.lit("no_pcm_header").alias("reason")))
