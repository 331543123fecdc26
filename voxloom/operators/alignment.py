"""Word and character alignment of transcript pairs.

``align`` gives the counts of an optimal word alignment. Costs are one per substitution, insertion and
deletion; equal words always pair up, and among equally cheap moves a substitution is taken before an
insertion and an insertion before a deletion, as seen from the end of both texts. Spark spreads the
pairs over tasks; inside a task the edit tables of pairs of like size are held as bits and stepped through together. A pair
too long for that has one integer per column, and only a block of columns at a time, so no text is too long.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import edits
from ..schemas import COUNTS, OP

_OPS = ["OK", "SUB", "INS", "DEL"]

# Table columns kept at a time while walking back; shorter hypotheses are kept whole.
_BLOCK = 256
# Words of both sides that are aligned at a time.
_WORDS = 1 << 18


def _next_column(match: int, up: int, down: int, full: int) -> tuple[int, int, int, int]:
    """One column of the edit table, held as bits (Myers 1999, Hyyrö 2003).

    Bit i of ``up`` (``down``) says that the cost rises (falls) from row i to row i + 1. The first two
    results say where the cost equals that of the diagonal cell and where it exceeds the cell to the left.
    """
    level = (((match & up) + up) ^ up | match | down) & full
    rise = down | full ^ (level | up)
    shifted = (rise << 1 | 1) & full
    return level, rise, (level & up) << 1 & full | full ^ (level | shifted), level & shifted


def _places(items: Sequence[str]) -> dict[str, int]:
    """For each distinct item, the bits of the positions it stands at."""
    where: dict[str, int] = {}
    for i, item in enumerate(items):
        where[item] = where.get(item, 0) | 1 << i
    return where


def distance(ref: Sequence[str], hyp: Sequence[str]) -> int:
    """Edit distance, one column of bits per item of the shorter side."""
    if len(ref) < len(hyp):
        ref, hyp = hyp, ref
    if not hyp:
        return len(ref)
    cost, full, last = len(ref), (1 << len(ref)) - 1, 1 << len(ref) - 1
    where, up, down = _places(ref), full, 0
    # The column step of above, written out here because this loop is the whole cost.
    for item in hyp:
        match = where.get(item, 0)
        level = (((match & up) + up) ^ up | match | down) & full
        rise, fall = down | full ^ (level | up), level & up
        if rise >= last:
            cost += 1
        elif fall >= last:
            cost -= 1
        rise = (rise << 1 | 1) & full
        up, down = fall << 1 & full | full ^ (level | rise), level & rise
    return cost


def walk(ref: Sequence[str], hyp: Sequence[str]) -> Iterator[tuple[str, int, int]]:
    """Moves of the alignment from the end of both sequences: op and the positions it stops at."""
    n, m = len(ref), len(hyp)
    full = (1 << n) - 1
    where = _places(ref)
    block = max(_BLOCK, isqrt(m))
    starts = []
    up, down = full, 0
    for j, word in enumerate(hyp):
        if j % block == 0:
            starts.append((up, down))
        if j < (m - 1) // block * block:
            _, _, up, down = _next_column(where.get(word, 0), up, down, full)
    i, j = n, m
    while starts and i:
        up, down = starts.pop()
        first = len(starts) * block
        columns = []
        for word in hyp[first : first + block]:
            level, rise, up, down = _next_column(where.get(word, 0), up, down, full)
            columns.append((level, rise))
        while i and j > first:
            if ref[i - 1] == hyp[j - 1]:
                i, j, op = i - 1, j - 1, "OK"
            else:
                level, rise = columns[j - 1 - first]
                if not level >> (i - 1) & 1:
                    i, j, op = i - 1, j - 1, "SUB"
                elif rise >> (i - 1) & 1:
                    j, op = j - 1, "INS"
                else:
                    i, op = i - 1, "DEL"
            yield op, i, j
    for j in range(j - 1, -1, -1):
        yield "INS", i, j
    for i in range(i - 1, -1, -1):
        yield "DEL", i, 0


def _alone(ref: edits.Sequences, hyp: edits.Sequences, row: int) -> tuple[list[int], list[int]]:
    """One pair of a batch as lists of numbers."""
    return tuple(side.codes[side.start[row] : side.start[row] + side.size[row]].tolist() for side in (ref, hyp))


def _moves(ref: edits.Sequences, hyp: edits.Sequences) -> Iterator[tuple[np.ndarray, ...]]:
    return edits.walks(ref, hyp, lambda row: [(_OPS.index(op), i, j) for op, i, j in walk(*_alone(ref, hyp, row))])


def _distances(ref: edits.Sequences, hyp: edits.Sequences, most: np.ndarray | None = None) -> np.ndarray:
    return edits.distances(ref, hyp, lambda row: distance(*_alone(ref, hyp, row)), most)


def _stretches(ref: pa.Array, hyp: pa.Array) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Parts of a batch of word lists with about ``_WORDS`` words, so that what is held beside a batch does not grow with it."""
    words = sum(pc.sum(pc.list_value_length(side)).as_py() or 0 for side in (ref, hyp))
    rows = max(1, len(ref) * _WORDS // max(words, _WORDS))
    for low in range(0, len(ref), rows):
        yield ref.slice(low, rows), hyp.slice(low, rows)


def count_batch(ref: pa.Array, hyp: pa.Array) -> pa.StructArray:
    """Alignment counts for one Arrow batch of word lists."""
    (ref, hyp), _ = edits.word_sequences(ref, hyp)
    counts = np.zeros((len(ref.size), len(_OPS)), np.int64)
    for row, op, _, _ in _moves(ref, hyp):
        low = int(row.min(initial=0))
        found = np.bincount((row - low) * len(_OPS) + op)
        found.resize(-(-len(found) // len(_OPS)) * len(_OPS))
        counts[low : low + len(found) // len(_OPS)] += found.reshape(-1, len(_OPS))
    return pa.StructArray.from_arrays([pa.array(counts[:, k], pa.int32()) for k in range(len(_OPS))], names=COUNTS.fieldNames())


def ops_batch(ref: pa.Array, hyp: pa.Array) -> pa.ListArray:
    """The alignments of one Arrow batch of word lists, built column by column."""
    parts = [_ops_of(*part) for part in _stretches(ref, hyp)] or [_ops_of(ref, hyp)]
    return pa.concat_arrays(parts) if len(parts) > 1 else parts[0]


def _ops_of(ref: pa.Array, hyp: pa.Array) -> pa.ListArray:
    (ref, hyp), words = edits.word_sequences(ref, hyp)
    parts = list(_moves(ref, hyp)) or [(np.zeros(0, np.int64),) * 4]
    row = np.concatenate([p[0] for p in parts])
    order = np.argsort(row, kind="stable")
    row, op, i, j = row[order], *(np.concatenate([p[k] for p in parts])[order].astype(np.int32) for k in (1, 2, 3))
    sides = []
    for side, place, gone in ((ref, i, op == edits.INS), (hyp, j, op == edits.DEL)):
        at = (side.start[row] + place)[~gone]
        code = np.zeros(len(row), np.int32)
        code[~gone] = side.codes[at]
        sides += [words.take(pa.array(code, mask=gone)).cast(pa.string()), pa.array(place, mask=gone)]
    names = pa.array(_OPS, pa.string()).take(pa.array(op))
    moves = pa.StructArray.from_arrays([names, sides[0], sides[2], sides[1], sides[3]], ["op", "ref", "hyp", "ref_pos", "hyp_pos"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(ref.size) + 1)).astype(np.int32)), moves)


def _confused(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(op, ref, hyp, n) of each batch of word lists (ref, hyp), each combination once a group of pairs."""
    for left, right in (part for batch in batches for part in _stretches(batch.column(0), batch.column(1))):
        (ref, hyp), words = edits.word_sequences(left, right)
        many = len(words) + 1
        for row, op, i, j in _moves(ref, hyp):
            # Numbers of words from 1; 0 where a side has none.
            left, right = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
            for code, side, place, there in ((left, ref, i, op != edits.INS), (right, hyp, j, op != edits.DEL)):
                code[there] = side.codes[(side.start[row] + place)[there]] + 1
            keys, n = np.unique((op * many + left) * many + right, return_counts=True)
            sides = [words.take(pa.array(np.maximum(c - 1, 0), mask=c == 0)).cast(pa.string()) for c in (keys // many % many, keys % many)]
            yield pa.RecordBatch.from_arrays([pa.array(_OPS, pa.string()).take(pa.array(keys // many // many)), *sides, pa.array(n, pa.int64())], ["op", "ref", "hyp", "n"])


def trace_ops(ref: Sequence[str], hyp: Sequence[str]) -> list[dict]:
    """The alignment of one pair from left to right, with 0-based positions in both texts."""
    ops = []
    for op, i, j in walk(ref, hyp):
        i, j = (None if op == "INS" else i), (None if op == "DEL" else j)
        words = (None if i is None else ref[i], None if j is None else hyp[j])
        ops.append({"op": op, "ref": words[0], "hyp": words[1], "ref_pos": i, "hyp_pos": j})
    return ops[::-1]


@lru_cache(maxsize=1)
def _udfs():
    @F.arrow_udf(COUNTS)
    def counts(ref: pa.Array, hyp: pa.Array) -> pa.Array:
        return count_batch(ref, hyp)

    @F.arrow_udf(T.ArrayType(OP))
    def ops(ref: pa.Array, hyp: pa.Array) -> pa.Array:
        return ops_batch(ref, hyp)

    @F.arrow_udf("int")
    def word_edits(ref: pa.Array, hyp: pa.Array) -> pa.Array:
        return pa.array(_distances(*edits.word_sequences(ref, hyp)[0]), pa.int32())

    @F.arrow_udf("int")
    def char_edits(ref: pa.Array, hyp: pa.Array) -> pa.Array:
        missing = pc.or_(ref.is_null(), hyp.is_null()).to_numpy(zero_copy_only=False)
        return pa.array(_distances(*edits.text_sequences(ref, hyp)), pa.int32(), mask=missing)

    @F.arrow_udf("int")
    def few_char_edits(ref: pa.Array, hyp: pa.Array, most: pa.Array) -> pa.Array:
        missing = pc.or_(pc.or_(ref.is_null(), hyp.is_null()), most.is_null()).to_numpy(zero_copy_only=False)
        most = pc.fill_null(most, -1).to_numpy(zero_copy_only=False)
        found = _distances(*edits.text_sequences(ref, hyp), most)
        return pa.array(found, pa.int32(), mask=missing | (found > most))

    # Called nondeterministic so that a filter on the result is not moved, with a second call, below the
    # repartitioning that spreads the work.
    return tuple(f.asNondeterministic() for f in (counts, ops, word_edits, char_edits, few_char_edits))


def align_counts(ref: Column, hyp: Column) -> Column:
    """Struct of correct, substituted, inserted and deleted words for two word arrays."""
    return _udfs()[0](ref, hyp)


def align_ops(ref: Column, hyp: Column) -> Column:
    """The alignment as an array of (op, ref, hyp, ref_pos, hyp_pos)."""
    return _udfs()[1](ref, hyp)


def align(df: DataFrame, ref: str = "ref_words", hyp: str = "hyp_words") -> DataFrame:
    """Add ``cor``, ``sub``, ``ins``, ``del`` and ``ref_len`` to each pair of word arrays.

    Spread the pairs before their texts are cut into words: raw text is the smaller thing to move.
    """
    counted = df.withColumn("_counts", align_counts(F.col(ref), F.col(hyp)))
    return counted.select(
        *df.columns, "_counts.cor", "_counts.sub", "_counts.ins", "_counts.del", F.size(ref).alias("ref_len")
    )


def word_distance(ref: Column, hyp: Column) -> Column:
    """Edit distance of two word arrays."""
    return _udfs()[2](ref, hyp)


def char_distance(ref: Column, hyp: Column, most: Column | None = None) -> Column:
    """Edit distance of two texts in characters; null where it is above ``most``, if that is given.

    Same value as the built-in ``levenshtein``, whose cost is the product of both lengths; here a text
    length of work covers 64 characters of the other text at a time, and only those that so many edits can reach.
    """
    return _udfs()[3](ref, hyp) if most is None else _udfs()[4](ref, hyp, most.cast("long"))


def cer(ref: Column, hyp: Column, below: float | None = None) -> Column:
    """Character error rate of one pair; null for an empty reference.

    With ``below``, rates that are not below it may be null: a pair is followed only as far as it takes to tell.
    """
    most = None if below is None else F.floor(F.length(ref) * F.lit(float(below)) + 1.0)
    return F.try_divide(char_distance(ref, hyp, most).cast("double"), F.length(ref))


def confusions(df: DataFrame, k: int | None = None, ref: str = "ref_words", hyp: str = "hyp_words") -> DataFrame:
    """How often each (op, reference word, hypothesis word) occurs; the ``k`` most frequent if asked."""
    # Tasks add up what they see of a group of pairs before a row of it leaves Python.
    found = df.select(ref, hyp).mapInArrow(_confused, "op string, ref string, hyp string, n long")
    counted = found.groupBy("op", "ref", "hyp").agg(F.sum("n").alias("n"))
    return counted if k is None else counted.orderBy(F.desc("n"), "op", "ref", "hyp").limit(k)
