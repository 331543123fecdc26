"""WAV files read by byte ranges: the pages of their heads, then only the bytes that are asked for.

``binaryFile`` loads a file whole, be it an hour long. Here rows name files and ranges, and tasks open the files themselves. What
is to be read is data like any other, so millions of segments need no plan on the driver; ranges are dealt into tasks by
their bytes and sorted, so that a task opens a file once and reads forward.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pcm
from ..functions.paths import base_name
from ..operators.filters import Split
from ..operators.segments import segment_sources
from ..session import settle, shared_folder
from .stores import locate

# Bytes that one task reads, as far as single rows allow, and bytes of one Arrow batch of results.
STRIPE = 64 << 20
# What opening a file counts as, in bytes: a task of short files holds few of them.
OPENING = 128 << 10
_BATCH = 16 << 20

_FORMAT = "channels int, sample_rate int, byte_rate long, block_align int, bits int, tag int, data_at long, data_bytes long"
PROBED = f"path string, {_FORMAT}, bytes_read long, reason string"


def wav_listing(spark: SparkSession, path: str, glob: str = "*.wav") -> DataFrame:
    """path (with its scheme) and length of the files below a folder; nothing of them is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length")


def probe_ranges(files: DataFrame, path: str = "path") -> Split:
    """Format, place of the samples and seconds of each file, and the bytes read for it. Files that cannot be opened,
    or are no WAVE of whole or floating-point samples, are rejects."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                found, taken, reason = None, 0, "no_path" if name is None else "unreadable"
                try:
                    if name is not None:
                        store, place = locate(name)
                        with store.open_input_file(place) as file:
                            pages = pcm.Pages(lambda at, n: file.read_at(n, at), file.size())
                            found = pcm.find_samples(pages)
                        taken, reason = pages.taken, None if found else "no_pcm_header"
                except OSError:
                    pass
                form = (found.channels, found.rate, found.byte_rate, found.align, found.bits, found.tag, found.data_at, found.data_bytes) if found else (None,) * 8
                rows.append((name, *form, taken, reason))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types], names)

    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    names, types = zip(*((n, kinds[t]) for n, t in (f.split() for f in PROBED.split(", "))))
    # A listing comes in tasks of a few dozen files, as if they were read whole; for their heads alone it is dealt anew. The number of
    # tasks is given, since by its own few bytes it would be one; it is written in as many files, which count as more than their bytes.
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = settle(files.select(F.col(path).cast("string").alias("path")).repartition(parts, "path"))
    probed = dealt.mapInArrow(run, PROBED)
    seconds = F.try_divide(F.col("data_bytes").cast("double"), (F.col("block_align") * F.col("sample_rate").cast("long")).cast("double"))
    known = probed.filter("reason IS NULL").drop("reason").withColumn("duration", seconds)
    return Split(known, probed.filter("reason IS NOT NULL").select("path", "reason"))


def dealt_by_bytes(ranges: DataFrame, stripe: int = STRIPE) -> DataFrame:
    """``ranges``, which have ``_path``, ``_first`` and ``_bytes``, written to the shared folder in as many files as there are
    stripes of bytes to be read, the opening of files counted in; a file of ranges is sorted by path and place."""
    spark = ranges.sparkSession
    path = f"{shared_folder(spark)}/ranges-{uuid.uuid4().hex}"
    # Ranges come from the heads of files, which are read once.
    ranges = settle(ranges)
    place = [F.col("_path"), F.floor(F.col("_first") / stripe)]
    total, opened = ranges.agg(F.sum("_bytes"), F.approx_count_distinct(F.struct(*place))).first()
    files = max(1, -(-((total or 0) + opened * OPENING) // stripe))
    dealt = ranges.repartition(files, *place).sortWithinPartitions("_path", "_first")
    dealt.write.parquet(path)
    return spark.read.schema(ranges.schema).parquet(path)


def read_ranges(ranges: DataFrame, make: Callable[[dict, bytes], list], schema: str, columns: list[str]) -> DataFrame:
    """A row for each row of ``ranges`` (_path, _first, _bytes, ...): its ``columns``, and what ``make`` gives for the row and its
    bytes as the further columns of ``schema``. A file that ends early gives the bytes that are there."""
    fields = ranges.select(*columns).schema
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    rest = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            made, low, size = [], 0, 0
            rows = batch.to_pylist()
            for n, row in enumerate(rows):
                if row["_path"] != name:
                    if file is not None:
                        file.close()
                    store, place = locate(row["_path"])
                    name, file = row["_path"], store.open_input_file(place)
                data = file.read_at(row["_bytes"], row["_first"]) if row["_bytes"] > 0 else b""
                made.append(make(row, data))
                size += len(data)
                if size >= _BATCH or n == len(rows) - 1:
                    part = batch.slice(low, n + 1 - low)
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], *[pa.array(list(c)) for c in zip(*made)]], [*columns, *rest])
                    made, low, size = [], n + 1, 0
        if file is not None:
            file.close()

    return ranges.mapInArrow(run, f"{kept}, {schema}")


def cut_ranges(segments: DataFrame, probed: DataFrame, col: str = "audio_filepath") -> Split:
    """The samples of each segment with a header of its own, and of each recording only those that segments need.

    ``probed`` is what ``probe_ranges`` keeps. Segments whose name tells no place, or whose recording is not there, are
    rejects; a segment that reaches beyond its recording ends with it. Whole and floating-point samples stay as they are.
    """
    named = segment_sources(segments, col)
    form = [F.col(c).alias(f"_{c}") for c in ("path", "channels", "sample_rate", "block_align", "bits", "tag", "data_at", "data_bytes")]
    tapes = probed.select(base_name(F.col("path")).alias("source"), *form)
    placed = named.filter("source IS NOT NULL AND seg_start IS NOT NULL AND seg_end IS NOT NULL").join(tapes, "source")
    frames = F.floor(F.col("_data_bytes") / F.col("_block_align"))
    first = F.least(F.greatest(F.round(F.col("seg_start") * F.col("_sample_rate")).cast("long"), F.lit(0)), frames)
    last = F.least(F.round(F.col("seg_end") * F.col("_sample_rate")).cast("long"), frames)
    ranges = placed.withColumn("_frame", first).withColumns(
        {"_bytes": F.greatest(last - F.col("_frame"), F.lit(0)) * F.col("_block_align"), "_first": F.col("_data_at") + F.col("_frame") * F.col("_block_align")}
    )

    def piece(row: dict, data: bytes) -> list:
        return [len(data), pcm.header(len(data), row["_sample_rate"], row["_channels"], row["_bits"], row["_tag"]) + data]

    needed = [f"_{c}" for c in ("path", "first", "bytes", "sample_rate", "channels", "bits", "tag")]
    dealt = dealt_by_bytes(ranges.select(*segments.columns, "source", *needed))
    cut = read_ranges(dealt, piece, "data_bytes long, content binary", [*segments.columns, "source"])
    known = tapes.select("source", F.lit(True).alias("_there")).distinct()
    reason = F.when(F.col("source").isNull() | F.col("seg_start").isNull() | F.col("seg_end").isNull(), "bad_name").when(F.col("_there").isNull(), "no_recording")
    lost = named.join(known, "source", "left").select(*segments.columns, reason.alias("reason"))
    return Split(cut, lost.filter("reason IS NOT NULL"))
