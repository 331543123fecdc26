"""Counts of words and of pairs of words, as files that tasks map into memory.

Keys are dealt by hash into parts of bounded size; a task sorts a part by a further hash and writes it as one file to the shared folder,
so nothing but names and sizes passes through the driver. A word gets a number, a pair is the numbers of its two words, and keys are compared
whole. A file of a local store is mapped as it is, so that the tasks of a machine share it; one of another store is copied
to a file without a name first. No table is held whole, or read again for further texts.
"""

from __future__ import annotations

import mmap
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.splits import MAX_WORD, _DIGIT, word_codes
from ..session import settle, shared_folder
from ..sources.stores import locate

# Words of one part on average; a part of words has numbers for twice as many.
PART = 1 << 18
_NUMBERS = 1 << 19
# Bits of the filter for each word.
_FILTER = 16

_MIX, _REMIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_KEYED = "part int, low long, high long, n long"
_WRITTEN = "part int, name string, entries long, first long"


@dataclass
class Table:
    """Where the parts of a table are: (name, entries, number of the first entry), the bits of a part's filter, 0 for none, and whether all keys found
    their place."""

    folder: str
    parts: list[tuple[str, int, int]]
    filter_bits: int
    whole: bool


@dataclass
class Part:
    """Keys of one or two numbers, sorted by slot, how often they occur, and where each slot begins."""

    low: np.ndarray
    high: np.ndarray | None
    n: np.ndarray
    slots: np.ndarray
    first: int


def _hash(low: np.ndarray, high: np.ndarray | None) -> np.ndarray:
    mixed = low.view(np.uint64) * _MIX
    if high is not None:
        mixed ^= high.view(np.uint64)
    mixed ^= mixed >> np.uint64(32)
    return mixed * _MIX


def _part(mixed: np.ndarray, parts: int) -> np.ndarray:
    return ((mixed >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _slot(mixed: np.ndarray, bits: int) -> np.ndarray:
    # The upper bits of a product depend on all bits of its factor.
    return (mixed * _REMIX >> np.uint64(64 - bits)).astype(np.int64)


def _bits(entries: int) -> int:
    return max(1, entries.bit_length())


def _words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, which texts are null) of texts without gaps between them."""
    null = texts.is_null().to_numpy(zero_copy_only=False)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0], null


def _keyed(part: np.ndarray, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(low), pa.array(high), pa.array(n)], ["part", "low", "high", "n"])


def _write(keyed: DataFrame, parts: int, two: bool, numbers: int = 0, filter_bits: int = 0) -> Table:
    """``keyed`` is (part, low, high, n); rows of part -1 only make the table one that lacks something. A part's numbers are those from the
    part times ``numbers`` on."""
    folder = f"{shared_folder(keyed.sparkSession)}/splits-{uuid.uuid4().hex}"

    def build(rows: pa.Table) -> pa.Table:
        if rows.column("part")[0].as_py() < 0:
            return pa.table({"part": pa.array([-1], pa.int32()), "name": [""], "entries": [0], "first": [0]})
        part, low, high, n = (rows.column(c).combine_chunks().to_numpy() for c in ("part", "low", "high", "n"))
        mixed, bits = _hash(low, high if two else None), _bits(len(low))
        slot = _slot(mixed, bits)
        order = np.argsort(slot, kind="stable")
        slots = np.append(0, np.cumsum(np.bincount(slot, minlength=1 << bits))).astype(np.int32)
        sides = [low[order], *([high[order]] if two else []), n[order], slots]
        if filter_bits:
            flags = np.zeros(1 << filter_bits, bool)
            flags[_slot(mixed, filter_bits)] = True
            sides.append(np.packbits(flags, bitorder="little"))
        # A task that runs again writes a file of another name, and only the names that reach the driver count.
        name = f"part-{uuid.uuid4().hex}"
        store, place = locate(folder)
        store.create_dir(place, recursive=True)
        with store.open_output_stream(f"{place}/{name}") as out:
            for side in sides:
                out.write(side)
        return pa.table({"part": part[:1], "name": [name], "entries": [len(low)], "first": [int(part[0]) * numbers]})

    found = {r["part"]: (r["name"], r["entries"], r["first"]) for r in keyed.groupBy("part").applyInArrow(build, _WRITTEN).collect()}
    # Parts may be empty.
    return Table(folder, [found.get(k, ("", 0, 0)) for k in range(parts)], filter_bits, -1 not in found)


def write_words(words: DataFrame, per: int = PART) -> Table:
    """The table of (word, n), distinct words of a-z and 0-9; n may be null for words that only pairs know."""
    words = settle(words)
    parts = max(1, -(-words.count() // per))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = _words_of(batch.column(0))
            low, high = word_codes(data, offsets[1:], np.diff(offsets))
            yield _keyed(_part(_hash(low, high), parts), low, high, pc.fill_null(batch.column(1), -1).to_numpy(zero_copy_only=False))

    keyed = words.select("word", F.col("n").cast("long")).mapInArrow(run, _KEYED)
    return _write(keyed, parts, True, _NUMBERS, _bits(_FILTER * min(per, PART) - 1))


def _sides(pairs: pa.Array):
    """(bytes, where first words begin and end, where second ones end, which rows) of the pairs of two usable words."""
    data, offsets, null = _words_of(pairs)
    blank = data == ord(" ")
    odd = np.append(0, np.cumsum((_DIGIT[data] == 0) & ~blank))
    blanks = np.append(0, np.cumsum(blank))
    good = ~null & (odd[offsets[1:]] == odd[offsets[:-1]]) & (blanks[offsets[1:]] - blanks[offsets[:-1]] == 1)
    row = np.flatnonzero(good)
    middle = np.flatnonzero(blank)[blanks[offsets[:-1][row]]] if len(row) else np.zeros(0, np.int64)
    first, second = middle - offsets[row], offsets[row + 1] - middle - 1
    fit = (first >= 1) & (first <= MAX_WORD) & (second >= 1) & (second <= MAX_WORD)
    return data, middle[fit], first[fit], second[fit], row[fit]


def second_words(pairs: DataFrame) -> DataFrame:
    """(word), the second words of (pair, n), of usable words both; a task names a word again in another batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *_, row = _sides(batch.column(0))
            found = pc.list_element(pc.split_pattern(batch.column(0).take(pa.array(row)), " "), 1) if len(row) else pa.array([], pa.string())
            yield pa.RecordBatch.from_arrays([found.unique().cast(pa.string())], ["word"])

    return pairs.select("pair").mapInArrow(run, "word string")


def write_pairs(pairs: DataFrame, words: Table, per: int = 4 * PART) -> Table:
    """The table of (pair, n) by the numbers of both words. Pairs of other than usable words are left out, and those whose first word was not counted;
    the table is not whole if ``words`` lacks a second word."""
    parts = max(1, -(-pairs.count() // per))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = word_finder(words)
        for batch in batches:
            data, middle, first, second, row = _sides(batch.column(0))
            (one, counted), (two, _) = (find(*word_codes(data, ends, size)) for ends, size in ((middle, first), (middle + 1 + second, second)))
            n = pc.fill_null(batch.column(1).take(pa.array(row)), 0).to_numpy(zero_copy_only=False)
            good = (counted > 0) & (n > 0)
            lacks = np.zeros(int((two[good] < 0).any()), np.int64)
            good &= two >= 0
            key = one[good] << 32 | two[good]
            part = np.append(_part(_hash(key, None), parts), lacks - 1)
            yield _keyed(part, np.append(key, lacks), np.zeros(len(part), np.int64), np.append(n[good], lacks))

    return _write(pairs.select("pair", F.col("n").cast("long")).mapInArrow(run, _KEYED), parts, False)


def _mapped(folder: str, name: str):
    store, place = locate(f"{folder}/{name}")
    if isinstance(store, fs.LocalFileSystem):
        with open(place, "rb") as file:
            return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    with store.open_input_stream(place) as source, tempfile.TemporaryFile() as file:
        shutil.copyfileobj(source, file, 1 << 24)
        file.flush()
        return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)


def _opened(table: Table, two: bool) -> tuple[list[Part | None], np.ndarray]:
    """The parts, None for empty ones, and the filters of all parts."""
    parts, filters = [], []
    wide = (1 << table.filter_bits) // 8 if table.filter_bits else 0
    for name, entries, first in table.parts:
        if not entries:
            parts.append(None)
            filters.append(np.zeros(wide, np.uint8))
            continue
        file, at, sides = _mapped(table.folder, name), 0, []
        for kind, size in [(np.int64, entries)] * (2 + two) + [(np.int32, (1 << _bits(entries)) + 1), (np.uint8, wide)]:
            sides.append(np.frombuffer(file, kind, size, at))
            at += sides[-1].nbytes
        *keys, n, slots, flags = sides
        parts.append(Part(keys[0], keys[1] if two else None, n, slots, first))
        filters.append(flags)
    return parts, np.concatenate(filters)


def _found(part: Part, mixed: np.ndarray, low: np.ndarray, high: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(which of the keys, where in the part) of the keys that the part has."""
    slot = _slot(mixed, _bits(len(part.low)))
    at, last = part.slots.take(slot), len(part.low) - 1
    # Most slots have one key; those of empty ones are met with the next slot's, which differs.
    hit = part.low.take(at, mode="clip") == low
    if high is not None:
        hit &= part.high.take(at, mode="clip") == high
    hit &= at <= last
    keys, places = [np.flatnonzero(hit)], [at[hit]]
    key = np.flatnonzero(~hit)
    at, end = at[key] + 1, part.slots.take(slot[key] + 1)
    while len(key):
        left = at < end
        key, at, end = key[left], at[left], end[left]
        hit = part.low[at] == low[key]
        if high is not None:
            hit &= part.high[at] == high[key]
        keys.append(key[hit])
        places.append(at[hit])
        key, at, end = key[~hit], at[~hit] + 1, end[~hit]
    return np.concatenate(keys), np.concatenate(places)


def _finder(table: Table, two: bool):
    state: list = []

    def opened() -> tuple[list[Part | None], np.ndarray]:
        if not state:
            state.append(_opened(table, two))
        return state[0]

    def find(low: np.ndarray, high: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        number, n = np.full(len(low), -1, np.int64), np.full(len(low), -1, np.int64)
        parts, mixed = opened()[0], _hash(low, high)
        mine = _part(mixed, len(parts)).astype(np.int16 if len(parts) < 1 << 15 else np.int32)
        # Keys of one part after another, so that a part is looked at once.
        order = np.argsort(mine, kind="stable")
        edge = np.append(0, np.cumsum(np.bincount(mine, minlength=len(parts)))).tolist()
        for k, part in enumerate(parts):
            if part is None or edge[k] == edge[k + 1]:
                continue
            if len(parts) == 1:
                key, place = _found(part, mixed, low, high)
            else:
                own = order[edge[k] : edge[k + 1]]
                key, place = _found(part, mixed.take(own), low.take(own), None if high is None else high.take(own))
                key = own.take(key)
            number[key], n[key] = part.first + place, part.n.take(place)
        return number, n

    return opened, find


def word_finder(table: Table) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """A function of word codes, as ``functions.splits`` makes them: number and count, -1 of words that are not known."""
    return _finder(table, True)[1]


def word_filter(table: Table) -> Callable[[np.ndarray, np.ndarray | None], np.ndarray]:
    """A function of word codes that tells fast which words may be known; of others some, but few, are told so, too."""
    opened, _ = _finder(table, True)
    bits = table.filter_bits

    def may(low: np.ndarray, high: np.ndarray | None) -> np.ndarray:
        parts, flags = opened()
        mixed = _hash(low, high)
        at = _slot(mixed, bits)
        if len(parts) > 1:
            at += _part(mixed, len(parts)) << bits
        return flags[at >> 3] >> (at & 7).astype(np.uint8) & 1 != 0

    return may


def pair_finder(table: Table) -> Callable[[np.ndarray], np.ndarray]:
    """A function of pair keys: their counts, -1 of pairs that are not known."""
    find = _finder(table, False)[1]
    return lambda key: find(key, None)[1]
