"""Hashes of words and word sequences for a whole Arrow batch at a time, in numpy.

Hashes have 64 bits. Words differ in hash unless 64 well-mixed bits agree by chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
_RUN = 4096


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random value per byte, powers of an odd base, and an odd factor per place in a word sequence."""
    draw = np.random.Generator(np.random.PCG64(20240607))
    value = draw.integers(1, 2**64 - 1, 256, dtype=np.uint64)
    powers = np.cumprod(np.full(_RUN, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
    factors = draw.integers(1, 2**63 - 1, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return value, powers, factors


BYTE_VALUE, POWERS, FACTORS = _tables()
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of the rows in the bytes) for blocks of about ``limit`` bytes.

    A longer text is a block of its own. Null texts are empty.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(at, at[low] + limit, "right")) - 1)
        high = min(high, len(texts))
        yield low, high, raw[at[low] : at[high]], at[low : high + 1] - at[low]
        low = high


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start, byte end and row of every word of a block; a word never crosses rows."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~IS_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A to Z as a to z; other bytes stay, so the text stays valid UTF-8."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def hash_pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte range; ranges do not overlap and none is empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    before = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(before, size)
    values = BYTE_VALUE[data[place + np.repeat(starts, size)]]
    values *= POWERS[place & (_RUN - 1)]
    if int(size.max()) > _RUN:
        values *= (2 * (place // _RUN) + 1).astype(np.uint64)
    return mix(np.add.reduceat(values, before) ^ (size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def sequences(words: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``k`` consecutive words of one row, and the number of its first word in the block."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += words[j : j + n] * FACTORS[j]
    at = np.flatnonzero(rows[:n] == rows[k - 1 : k - 1 + n])
    return mix(total[at]), at


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value, the leftmost if equal, of every ``width`` consecutive values."""
    n = len(values) - width + 1
    best = values[:n].copy()
    at = np.arange(n)
    for j in range(1, width):
        other = values[j : j + n]
        less = other < best
        best[less] = other[less]
        at[less] = np.flatnonzero(less) + j
    return at
