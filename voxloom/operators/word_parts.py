"""Tables of words of any size, written as trees in parts that tasks load in turn.

The words are dealt by hash into parts of bounded size. A task builds the tree of a part and writes it to the shared folder; no word
passes through the driver. A scan of texts then holds one batch of texts and one part at a time. Parts that
are small together stay with the task, others are read again for each batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import trie
from ..session import shared_folder
from ..sources.stores import locate

# Words, and bytes of words and what goes with them, of one part on average.
PART_WORDS = 50_000
PART_BYTES = 4 << 20
# Bytes of parts that a task keeps.
_KEEP = 64 << 20

_PART = "part long, words binary, ends binary, notes binary, note_ends binary, places binary, keys binary, child binary, word binary"


@dataclass
class Part:
    """Words with a note and a number each, and their tree."""

    words: list[bytes]
    notes: np.ndarray
    note_ends: np.ndarray
    places: np.ndarray
    tree: trie.Trie


def _joined(values: list[bytes]) -> tuple[bytes, bytes]:
    return b"".join(values), np.cumsum([len(v) for v in values], dtype=np.int64).tobytes()


def write_parts(words: DataFrame, per: int = PART_WORDS) -> str:
    """The folder of the parts of ``words`` (word, note, place), which repeat no word; note and place may be null, as "" and 0."""
    folder = f"{shared_folder(words.sparkSession)}/words-{uuid.uuid4().hex}"
    sized = words.agg(F.count(F.lit(1)), F.sum(F.octet_length("word") + F.coalesce(F.octet_length("note"), F.lit(0)))).first()
    parts = max(1, -(-sized[0] // per), -(-(sized[1] or 0) // PART_BYTES))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("word")
        listed = [w.encode() for w in rows["word"]]
        notes = [(n or "").encode() for n in rows["note"].where(rows["note"].notna(), "")]
        made = trie.build(listed)
        places = rows["place"].fillna(0).to_numpy(np.int64)
        packed = [*_joined(listed), *_joined(notes), places.tobytes(), made.keys.tobytes(), made.child.tobytes(), made.word.tobytes()]
        return pd.DataFrame([[int(rows["part"].iloc[0]), *packed]], columns=[f.split()[0] for f in _PART.split(", ")])

    dealt = words.select(F.pmod(F.xxhash64("word"), F.lit(parts)).alias("part"), "word", F.col("note").cast("string"), F.col("place").cast("bigint"))
    dealt.groupBy("part").applyInPandas(build, _PART).write.parquet(folder)
    return folder


def _unpack(row: dict) -> Part:
    def cut(data: bytes, ends: np.ndarray) -> list[bytes]:
        return [data[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]

    ends = np.frombuffer(row["ends"], np.int64)
    tree = trie.Trie(*(np.frombuffer(row[c], t) for c, t in (("keys", np.int64), ("child", np.int32), ("word", np.int32))), np.diff(ends, prepend=0))
    note_ends = np.frombuffer(row["note_ends"], np.int64)
    return Part(cut(row["words"], ends), np.frombuffer(row["notes"], np.uint8), note_ends, np.frombuffer(row["places"], np.int64), tree)


def part_reader(folder: str) -> Callable[[], Iterator[Part]]:
    """What a task calls for each batch: the parts below ``folder``, one after another."""
    kept: list[Part] = []
    state = {"all": False, "bytes": 0}

    def parts() -> Iterator[Part]:
        if state["all"]:
            yield from kept
            return
        kept.clear()
        state["bytes"] = 0
        store, place = locate(folder)
        for file in sorted(f.path for f in store.get_file_info(fs.FileSelector(place)) if f.base_name.endswith(".parquet")):
            with pq.ParquetFile(store.open_input_file(file)) as opened:
                for batch in opened.iter_batches(batch_size=1):
                    for row in batch.to_pylist():
                        part = _unpack(row)
                        state["bytes"] += sum(len(v) for v in row.values() if isinstance(v, bytes))
                        if state["bytes"] <= _KEEP:
                            kept.append(part)
                        yield part
        state["all"] = state["bytes"] <= _KEEP
        if not state["all"]:
            kept.clear()

    return parts


def found_words(folder: str):
    """A function of a text column: the words of the parts that a text contains, as structs of word and place."""
    kind = pa.struct([("keyword", pa.string()), ("place", pa.int64())])
    parts = part_reader(folder)

    @F.arrow_udf("array<struct<keyword:string,place:bigint>>")
    def hits(texts: pa.Array) -> pa.Array:
        rows, words, places = [], [], []
        there = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False))
        for part in parts():
            always = [k for k, w in enumerate(part.words) if not w]
            for k in always:
                rows.append(there)
                words.append(pa.array([""] * len(there), pa.string()))
                places.append(np.full(len(there), part.places[k]))
            listed = pa.array([w.decode() for w in part.words], pa.string())
            for low, _, data, offsets in trie.blocks(texts):
                row, word = trie.contained(part.tree, data, offsets)
                rows.append(row + low)
                words.append(listed.take(pa.array(word)))
                places.append(part.places[word])
        if not rows:
            return pa.array([[]] * len(texts), pa.list_(kind))
        row = np.concatenate(rows)
        order = np.argsort(row, kind="stable")
        values = pa.StructArray.from_arrays([pa.concat_arrays(words).take(pa.array(order)), pa.array(np.concatenate(places)[order])], ["keyword", "place"])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(row[order], np.arange(len(texts) + 1)).astype(np.int32)), values)

    return hits


def first_texts(folder: str, cap: int):
    """A function for ``mapInArrow`` over (order, text digest, text) rows in order: (keyword, place, order, digest) for the first ``cap`` texts that
    contain each word among those of the task.

    A word that has its texts is looked for no more, and trees are built anew when half of their words are done, so most of a scan is for rare words.
    """
    parts = part_reader(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Texts still wanted of each word of each part; the words that the tree at hand looks for, and that tree.
        left: list[np.ndarray] = []
        trees: dict[int, tuple[np.ndarray, trie.Trie]] = {}
        for batch in batches:
            texts, orders, digests = (batch.column(c) for c in ("_col", "_order", "_text"))
            there = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False))
            pieces = list(trie.blocks(texts))
            for k, part in enumerate(parts()):
                if k == len(left):
                    left.append(np.full(len(part.words), cap, np.int64))
                wanted = left[k]
                empty = np.flatnonzero([not w for w in part.words])
                for low, _, data, offsets in [(0, 0, None, None), *pieces]:
                    if data is None:
                        # Every text has the empty word.
                        row, word = np.tile(there, len(empty)), np.repeat(empty, len(there))
                    else:
                        live = np.flatnonzero((wanted > 0) & (part.tree.size > 0))
                        if not len(live):
                            break
                        listed, tree = trees.get(k, (np.arange(len(part.words)), part.tree))
                        if 2 * len(live) <= len(listed):
                            listed, tree = live, trie.build([part.words[w] for w in live])
                            trees[k] = listed, tree
                        row, word = trie.contained(tree, data, offsets)
                        row, word = row + low, listed[word]
                    # By word, in the order of rows; the first of each that are still wanted.
                    order = np.lexsort((row, word))
                    row, word = row[order], word[order]
                    keep = np.arange(len(word)) - np.searchsorted(word, word, "left") < wanted[word]
                    row, word = row[keep], word[keep]
                    wanted -= np.bincount(word, minlength=len(wanted))
                    if len(row):
                        names = pa.array([part.words[w].decode() for w in word.tolist()], pa.string())
                        yield pa.RecordBatch.from_arrays([names, pa.array(part.places[word]), orders.take(pa.array(row)), digests.take(pa.array(row))], ["keyword", "kw_ord", "_order", "_text"])

    return run


def replaced_words(folder: str):
    """A function of a text column: the text with words replaced by their notes, read from left to right, the longest word first."""
    parts = part_reader(folder)

    @F.arrow_udf("string")
    def swap(texts: pa.Array) -> pa.Array:
        pieces = [(low, high, data, offsets) for low, high, data, offsets in trie.blocks(texts)]
        # The longest word at each place over all parts, where its note is, and the notes themselves.
        best = [[np.zeros(len(data), np.int64) for _ in range(3)] for _, _, data, _ in pieces]
        pools: list[list[np.ndarray]] = [[] for _ in pieces]
        pool_size = [0] * len(pieces)
        for part in parts():
            starts = part.note_ends - np.diff(part.note_ends, prepend=0)
            for k, (_, _, data, offsets) in enumerate(pieces):
                word = trie.longest(part.tree, data, offsets)
                at = np.flatnonzero(word >= 0)
                better = at[part.tree.size[word[at]] > best[k][0][at]]
                used, place = np.unique(word[better], return_inverse=True)
                # Only the notes that are needed are kept.
                sizes = part.note_ends[used] - starts[used]
                notes = np.concatenate([part.notes[a:b] for a, b in zip(starts[used], part.note_ends[used])]) if len(used) else part.notes[:0]
                first = pool_size[k] + np.cumsum(sizes) - sizes
                best[k][0][better], best[k][1][better], best[k][2][better] = part.tree.size[word[better]], first[place], sizes[place]
                pools[k].append(notes)
                pool_size[k] += len(notes)
        out = []
        for (_, _, data, offsets), (size, note_at, note_size), pool in zip(pieces, best, pools):
            at = trie.chosen(size, offsets)
            pool = np.concatenate(pool) if pool else data[:0]
            changed, ends = trie.replace(data, offsets, at, size[at], pool, note_at[at], note_size[at])
            out.append(pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(changed.tobytes())))
        made = pa.concat_arrays(out) if out else pa.array([], pa.large_string())
        nulls = texts.is_null()
        return pc.if_else(nulls, pa.scalar(None, pa.large_string()), made).cast(pa.string())

    return swap
