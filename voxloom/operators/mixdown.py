"""Recordings laid over one another: overtalk and backchannels as samples.

A track says at which sample of which result a recording starts. Recordings come as frames, stretches of a fixed number of
samples; moved by its start, a frame covers parts of two frames of the result at most, and the parts of a frame are
added up. So an hour-long call is many small rows, of which a task holds one sum at a time, however many tracks meet in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.wav import pcm_header
from ..session import settle
from ..sources.keyed_files import write_keyed
from .filters import Split

# Samples of a frame: about half a minute at 16 kHz, 1 MB.
FRAME = 1 << 19


def overtalk_tracks(plan: DataFrame, rate: int, out: str = "out") -> DataFrame:
    """Two tracks for each pair of an overtalk plan: the first recording at once, the second at its time.

    The result is named by both recordings, with a plus sign between.
    """
    name = F.concat_ws("+", "first_path", "second_path").alias(out)
    late = F.round(F.col("second_start") * rate).cast("bigint")
    both = F.array(
        F.struct(F.col("first_path").alias("path"), F.lit(0).cast("bigint").alias("at")),
        F.struct(F.col("second_path").alias("path"), late.alias("at")),
    )
    return plan.select(name, F.inline(both))


def backchannel_tracks(worded: DataFrame, clips: DataFrame, rate: int, out: str = "out") -> DataFrame:
    """Each recording of ``worded``, which is what ``insert_backchannels`` gives, and a track for each word inserted in it.

    ``clips`` has (word, path), a recording per word.
    """
    whole = worded.select(F.col("audio_filepath").alias(out)).distinct()
    whole = whole.select(out, F.col(out).alias("path"), F.lit(0).cast("bigint").alias("at"))
    words = worded.filter("inserted").join(clips.select("word", "path"), "word", "left")
    return whole.unionByName(words.select(F.col("audio_filepath").alias(out), "path", F.round(F.col("start") * rate).cast("bigint").alias("at")))


def _summed(batches: Iterator[pa.RecordBatch], frame: int) -> Iterator[pa.RecordBatch]:
    """Sums of the parts (out, frame, off, pcm), which are sorted by result and frame, held within 16 bits."""
    now, total = None, None

    def closed() -> pa.RecordBatch:
        pcm = np.clip(total, -32768, 32767).astype("<i2").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.string()), pa.array([now[1]], pa.int64()), pa.array([pcm], pa.binary())], ["out", "frame", "pcm"])

    for batch in batches:
        for out, number, off, pcm in zip(*(batch.column(k) for k in range(4))):
            key = out.as_py(), number.as_py()
            if key != now:
                if now is not None:
                    yield closed()
                now, total = key, np.zeros(frame, np.int64)
            x = np.frombuffer(pcm.as_buffer(), "<i2")
            at = off.as_py()
            total[at : at + len(x)] += x
    if now is not None:
        yield closed()


def mix_down(tracks: DataFrame, chunks: DataFrame, frame: int = FRAME) -> Split:
    """(out, frame, samples, pcm) for each frame of each result: 16-bit sums of its tracks, silence where there are none.

    ``tracks`` is (out, path, at); ``chunks`` is what ``convert`` makes at the rate of ``at``, of ``frame`` samples at most; ``samples`` is the
    length of the whole result. A recording that is named twice sounds twice. Tracks without a result's name, with a start that is null or
    negative, or whose recording is not there, are rejects; a result of which every track is one is not made.
    """
    bad = F.when(F.col("out").isNull(), "no_name").when(F.col("at").isNull() | (F.col("at") < 0), "bad_start")
    # Read three times; what converts recordings opens all of their files.
    chunks = settle(chunks.select("path", "first_out", "pcm"))
    known = chunks.select("path").distinct().withColumn("_there", F.lit(True))
    tagged = tracks.select(F.col("out").cast("string"), "path", F.col("at").cast("bigint").alias("at")).withColumn("_bad", bad).join(known, "path", "left")
    tagged = tagged.withColumn("reason", F.coalesce("_bad", F.when(F.col("_there").isNull(), "no_recording")))
    good = tagged.filter("reason IS NULL").select("out", "path", "at")
    placed = good.join(chunks.select("path", "first_out", "pcm"), "path")
    start = F.col("at") + F.col("first_out")
    placed = placed.select("out", "pcm", start.alias("_start"), F.floor(F.octet_length("pcm") / 2).alias("_n"))
    lengths = placed.groupBy("out").agg(F.max(F.col("_start") + F.col("_n")).alias("samples"))
    first, off = F.floor(F.col("_start") / frame), F.pmod("_start", F.lit(frame).cast("bigint"))
    room = (F.lit(frame) - off).cast("int")
    parts = F.array(
        F.struct(first.alias("frame"), off.cast("int").alias("off"), F.substr("pcm", F.lit(1), room * 2).alias("pcm")),
        F.struct((first + 1).alias("frame"), F.lit(0).alias("off"), F.substr("pcm", room * 2 + 1, F.greatest(F.octet_length("pcm") - room * 2, F.lit(0))).alias("pcm")),
    )
    cut = placed.select("out", F.inline(parts)).filter(F.octet_length("pcm") > 0)
    # The number is given, so that adaptive execution does not put all short frames into one task.
    dealt = cut.repartition(int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")), "out", "frame").sortWithinPartitions("out", "frame")
    sums = dealt.mapInArrow(lambda batches: _summed(batches, frame), "out string, frame long, pcm binary")
    last = F.floor((F.greatest("samples", F.lit(1)) - 1) / frame)
    grid = lengths.select("out", "samples", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("frame"))
    # A frame without sound is zeros; two hexadecimal digits a byte.
    silent = F.unhex(F.repeat(F.lit("00"), frame * 2))
    size = F.least(F.lit(frame), F.col("samples") - F.col("frame") * frame).cast("int") * 2
    full = grid.join(sums, ["out", "frame"], "left").select("out", "frame", "samples", F.substr(F.coalesce("pcm", silent), F.lit(1), size).alias("pcm"))
    return Split(full, tagged.filter("reason IS NOT NULL").select("out", "path", "at", "reason"))


def write_mix(mixed: DataFrame, folder: str, rate: int, mode: str = "overwrite") -> None:
    """Each result of ``mix_down`` as a WAV file ``<out>.wav``, one channel, 16 bits; its frames are streamed into it."""
    head = F.when(F.col("frame") == 0, pcm_header(F.col("samples") * 2, F.lit(rate), F.lit(1), F.lit(16))).otherwise(F.lit(b""))
    write_keyed(mixed, folder, F.concat("out", F.lit(".wav")), F.concat(head, "pcm"), ["frame"], mode)
