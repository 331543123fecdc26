"""Reading PCM WAV headers, and writing canonical ones, with binary column expressions; samples are packed in an Arrow function."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

HEADER_BYTES = 44


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def _uint(hexed: Column, at: int, size: int) -> Column:
    """Little-endian unsigned integer at a 1-based byte position of a hex text."""
    pairs = [F.substring(hexed, 2 * (at + k) - 1, 2) for k in reversed(range(size))]
    return F.conv(F.concat(*pairs), 16, 10).cast("bigint")


# Chunks that one fold looks at; files of today have four or five. Where that is not enough, a longer fold goes to the end.
FEW_CHUNKS = 16


def _walk(content: Column) -> Column:
    """Step from chunk to chunk: the format chunk as hex text, and where the samples begin and how many bytes they have."""
    start = F.struct(
        F.lit(13).cast("bigint").alias("at"), F.lit("").alias("fmt"), F.lit(0).cast("bigint").alias("data_at"), F.lit(0).cast("bigint").alias("data_bytes")
    )

    def step(acc: Column, _: Column) -> Column:
        head = F.hex(F.substring(content, acc["at"].cast("int"), F.lit(8)))
        size = _uint(head, 5, 4)
        name = F.substring(head, 1, 8)
        body = acc["at"] + 8
        following = (body + size + size % 2).alias("at")
        found = F.struct(
            following,
            acc["fmt"].alias("fmt"),
            body.alias("data_at"),
            # A file that was cut off, or written without knowing its length, has what is there.
            F.least(size, F.greatest(F.octet_length(content) - body + 1, F.lit(0).cast("bigint"))).alias("data_bytes"),
        )
        form = F.struct(
            following,
            F.hex(F.substring(content, body.cast("int"), F.lit(16))).alias("fmt"),
            acc["data_at"].alias("data_at"),
            acc["data_bytes"].alias("data_bytes"),
        )
        other = F.struct(following, acc["fmt"].alias("fmt"), acc["data_at"].alias("data_at"), acc["data_bytes"].alias("data_bytes"))
        ended = (acc["data_at"] > 0) | (F.coalesce(F.length(head), F.lit(0)) < 16)
        return (
            F.when(ended, acc)
            .when(name == b"data".hex().upper(), found)
            .when(name == b"fmt ".hex().upper(), form)
            .otherwise(other)
        )

    def further(few: Column) -> Column:
        # A chunk has eight bytes at least, so that many steps reach the end of any file.
        most = F.greatest(F.ceil(F.octet_length(content) / 8), F.lit(1)).cast("int")
        open_end = (few["data_at"] == 0) & (few["at"] + 7 <= F.octet_length(content))
        return F.when(open_end, F.aggregate(F.sequence(F.lit(1), most), few, step)).otherwise(few)

    return let(F.aggregate(F.sequence(F.lit(1), F.lit(FEW_CHUNKS)), start, step), further)


def pcm_info(content: Column) -> Column:
    """Struct of format fields and of where the samples begin, from 1; null unless the file is PCM in a RIFF WAVE.

    Other chunks may stand before or between the format and the samples.
    """

    def is_wave(c: Column) -> Column:
        outer = F.hex(F.substring(c, 1, 12))
        return (F.substring(outer, 1, 8) == b"RIFF".hex().upper()) & (F.substring(outer, 17, 8) == b"WAVE".hex().upper())

    def fields(found: Column) -> Column:
        form = found["fmt"]
        good = (F.length(form) == 32) & (_uint(form, 1, 2) == 1) & (found["data_at"] > 0)
        return F.when(
            good,
            F.struct(
                _uint(form, 3, 2).cast("int").alias("channels"),
                _uint(form, 5, 4).cast("int").alias("sample_rate"),
                _uint(form, 9, 4).alias("byte_rate"),
                _uint(form, 13, 2).cast("int").alias("block_align"),
                _uint(form, 15, 2).cast("int").alias("bits"),
                found["data_bytes"].alias("data_bytes"),
                found["data_at"].alias("data_at"),
            ),
        )

    # Named once, so that content which is itself an expression is not computed at every step.
    return let(content, lambda c: F.when(is_wave(c), let(_walk(c), fields)))


def little_endian(value: Column, size: int) -> Column:
    """Hex text of the value's low bytes, lowest first."""
    text = F.lpad(F.hex(value.cast("bigint")), 16, "0")
    return F.concat(*[F.substring(text, 15 - 2 * k, 2) for k in range(size)])


def pcm_header(data_bytes: Column, rate: Column, channels: Column, bits: Column) -> Column:
    align = channels * bits / 8
    hexed = F.concat(
        F.hex(F.lit("RIFF")),
        little_endian(data_bytes + 36, 4),
        F.hex(F.lit("WAVEfmt ")),
        little_endian(F.lit(16), 4),
        little_endian(F.lit(1), 2),
        little_endian(channels, 2),
        little_endian(rate, 4),
        little_endian(rate * align, 4),
        little_endian(align, 2),
        little_endian(bits, 2),
        F.hex(F.lit("data")),
        little_endian(data_bytes, 4),
    )
    return F.unhex(hexed)


@lru_cache(maxsize=1)
def _pcm_udf():
    @F.arrow_udf("binary")
    def packed(samples: pa.Array) -> pa.Array:
        values = pc.fill_null(samples.flatten().cast(pa.float64()), 1.0).to_numpy(zero_copy_only=False)
        # What is no number is loudest, as the greatest of all values.
        steps = np.clip(np.where(np.isnan(values), 1.0, values), -1.0, 1.0) * 32767
        whole = np.floor(np.abs(steps))
        whole += np.abs(steps) - whole >= 0.5
        data = np.copysign(whole, steps).astype("<i2").tobytes()
        size = pc.fill_null(pc.list_value_length(samples), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(2 * size)]).astype(np.int64)
        made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(samples), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        return pc.if_else(samples.is_null(), pa.scalar(None, pa.large_binary()), made).cast(pa.binary())

    return packed


def pcm_bytes(samples: Column) -> Column:
    """16-bit PCM of samples in [-1, 1], rounded half away from zero; a missing sample is 1."""
    return _pcm_udf()(samples)
