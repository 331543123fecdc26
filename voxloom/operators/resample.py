"""Recordings brought to one rate, one channel and 16 bits, in chunks.

A sample of the result is a weighted mean of the input around its time: weights are a sinc at the lower of both rates'
band, under a squared-cosine window of ``ZEROS`` crossings to each side, divided by their sum. Rates are in the ratio of two whole
numbers, so there are only as many sets of weights, or phases, as the numerator. A chunk of the result needs its own stretch of the input and a halo of half
a window; it reads just these bytes, and chunks joined are the result of the whole file, bit for bit.
"""

from __future__ import annotations

from math import ceil, gcd

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pcm
from ..functions.paths import base_name
from ..sources.keyed_files import write_keyed
from ..sources.wav_ranges import dealt_by_bytes, read_ranges

ZEROS = 16
# The part of the lower band that passes; what lies above would fold back.
BAND = 0.95
# Samples of the result in a chunk: about a minute at 16 kHz, 2 MB.
CHUNK = 1 << 20


def ratio(rate_in: int, rate_out: int) -> tuple[int, int]:
    """Samples out and in of the shortest stretch that is whole at both rates."""
    shared = gcd(rate_in, rate_out)
    return rate_out // shared, rate_in // shared


def half_width(up: int, down: int) -> int:
    """Input samples to each side that a sample of the result may depend on; none where the rate stays."""
    return 0 if up == down else ceil(ZEROS * max(1.0, down / up) / BAND)


def weights(up: int, down: int) -> np.ndarray:
    """For each phase r the weights of the input samples from -half + 1 to half around the floor of the result's time."""
    if up == down:
        return np.ones((1, 1))
    half, cut = half_width(up, down), BAND * min(1.0, up / down)
    t = np.arange(-half + 1, half + 1)[None, :] - np.arange(up)[:, None] / up
    w = np.where(np.abs(t) < ZEROS / cut, np.sinc(cut * t) * np.cos(np.pi * t * cut / (2 * ZEROS)) ** 2, 0.0)
    return w / w.sum(1, keepdims=True)


def resample(x: np.ndarray, first_in: int, first_out: int, count: int, up: int, down: int, table: np.ndarray | None = None) -> np.ndarray:
    """Samples ``first_out`` and on of the result; ``x`` is the input from sample ``first_in``, silence around it."""
    table = weights(up, down) if table is None else table
    half = half_width(up, down)
    time = (first_out + np.arange(count, dtype=np.int64)) * down
    at, phase = time // up - first_in, time % up
    if up == down:
        return np.pad(x, (0, max(0, int(at[-1]) + 1 - len(x))))[at] if count else x[:0]
    before, after = max(0, half - 1 - int(at.min(initial=0))), max(0, int(at.max(initial=0)) + half + 1 - len(x))
    padded = np.pad(x, (before, after))
    out = np.empty(count)
    for low in range(0, count, 1 << 14):
        part = slice(low, low + (1 << 14))
        seen = padded[(at[part] + before)[:, None] + np.arange(-half + 1, half + 1)]
        out[part] = np.einsum("ij,ij->i", seen, table[phase[part]])
    return out


def conversion_plan(probed: DataFrame, rate: int = 16000, chunk: int = CHUNK) -> DataFrame:
    """A row for each chunk of each file's result: which samples it holds, and which bytes of the file it needs."""
    shared = F.expr(f"aggregate(sequence(1, 64), struct(cast(sample_rate as bigint) as a, cast({rate} as bigint) as b), (s, _) -> if(s.b = 0, s, struct(s.b as a, s.a % s.b as b)), s -> s.a)")
    up, down = (F.lit(rate) / shared).cast("long"), (F.col("sample_rate") / shared).cast("long")
    sized = probed.withColumns({"up": up, "down": down, "frames": F.floor(F.col("data_bytes") / F.col("block_align"))})
    sized = sized.withColumn("samples", F.ceil(F.col("frames").cast("decimal(20,0)") * F.col("up") / F.col("down")).cast("long"))
    half = F.when(F.col("up") == F.col("down"), F.lit(0)).otherwise(F.ceil(ZEROS * F.greatest(F.lit(1.0), F.col("down") / F.col("up")) / F.lit(BAND)))
    cut = sized.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.greatest("samples", F.lit(1)) - 1) / chunk))))
    cut = cut.withColumn("first_out", F.col("chunk") * chunk).withColumn("count", F.least(F.lit(chunk).cast("long"), F.col("samples") - F.col("first_out")))
    time = F.floor(F.col("first_out") * F.col("down") / F.col("up"))
    last = F.floor((F.col("first_out") + F.col("count")) * F.col("down") / F.col("up"))
    cut = cut.withColumn("first_in", F.least(F.greatest(time - half - 1, F.lit(0)), F.col("frames"))).withColumn("_last", F.least(last + half + 2, F.col("frames")))
    return cut.select(
        F.col("path").alias("_path"), "channels", "bits", "tag", "up", "down", "samples", "chunk", "first_out", "count", "first_in",
        (F.col("data_at") + F.col("first_in") * F.col("block_align")).alias("_first"),
        (F.greatest(F.col("_last") - F.col("first_in"), F.lit(0)) * F.col("block_align")).alias("_bytes"),
    )


def convert(probed: DataFrame, rate: int = 16000, chunk: int = CHUNK) -> DataFrame:
    """path, samples (of the whole result), chunk, first_out and ``pcm``, the 16-bit samples of the chunk.

    ``probed`` is what ``probe_ranges`` keeps. Channels are averaged; whole numbers of other widths and floating-point samples are
    brought to 16 bits, rounded to the nearest step and held within the range. A file without samples has one empty chunk.
    """
    tables: dict[tuple[int, int], np.ndarray] = {}

    def make(row: dict, data: bytes) -> list:
        key = row["up"], row["down"]
        if key not in tables:
            tables.clear()
            tables[key] = weights(*key)
        x = pcm.decode(data, row["channels"], row["bits"], row["tag"]).mean(1)
        return [pcm.encode16(resample(x, row["first_in"], row["first_out"], row["count"], *key, tables[key]))]

    plan = dealt_by_bytes(conversion_plan(probed, rate, chunk))
    return read_ranges(plan, make, "pcm binary", ["_path", "samples", "chunk", "first_out"]).withColumnRenamed("_path", "path")


def write_converted(probed: DataFrame, folder: str, rate: int = 16000, chunk: int = CHUNK, mode: str = "overwrite") -> None:
    """Each recording as a WAV file of its name in ``folder``, at ``rate``, one channel, 16 bits; chunks are streamed into it."""
    from ..functions.wav import pcm_header

    chunks = convert(probed, rate, chunk)
    head = F.when(F.col("chunk") == 0, pcm_header(F.col("samples") * 2, F.lit(rate), F.lit(1), F.lit(16))).otherwise(F.lit(b""))
    write_keyed(chunks, folder, base_name(F.col("path")), F.concat(head, "pcm"), ["path", "chunk"], mode)
