"""Byte-level BPE: whole texts to token ids by a table of ranks, and ids back to bytes.

A text is cut by a pattern; the bytes of each piece are merged, always the neighbours of lowest rank first. Merging
depends on the piece alone, so a task merges each distinct piece once and looks repeats up.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carry, give_back, worker_memo

# Distinct pieces a task remembers; beyond that it starts anew, which costs time only.
REMEMBERED = 150_000
_LONG_PIECE = 96


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """A rank file: lines of a piece in base 64 and its rank. Every byte needs a rank of its own."""
    ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, raw.splitlines())}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("some byte has no rank")
    return ranks


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece. Of neighbours with equal rank the leftmost are merged first."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > _LONG_PIECE:
        return _merge_long(piece, ranks)
    parts = [piece[k : k + 1] for k in range(len(piece))]
    get, none = ranks.get, len(ranks)
    costs = [get(a + b, none) for a, b in zip(parts, parts[1:])]
    while costs:
        low = min(costs)
        if low == none:
            break
        k = costs.index(low)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
        del costs[k]
        if k < len(costs):
            costs[k] = get(parts[k] + parts[k + 1], none)
        if k:
            costs[k - 1] = get(parts[k - 1] + parts[k], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same result by a heap over linked parts, so that time grows little faster than the length."""
    n = len(piece)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for k in range(n - 1):
        rank = ranks.get(piece[k : k + 2])
        if rank is not None:
            heap.append((rank, k, k + 2))
    heapify(heap)
    alive = [True] * n
    while heap:
        _, k, stop = heappop(heap)
        if not alive[k] or after[k] >= n or end[after[k]] != stop:
            continue
        gone = after[k]
        alive[gone] = False
        end[k], after[k] = stop, after[gone]
        if after[k] < n:
            before[after[k]] = k
            rank = ranks.get(piece[k : end[after[k]]])
            if rank is not None:
                heappush(heap, (rank, k, end[after[k]]))
        if before[k] >= 0:
            rank = ranks.get(piece[before[k] : stop])
            if rank is not None:
                heappush(heap, (rank, before[k], stop))
    return [ranks[piece[k : end[k]]] for k in range(n) if alive[k]]


class _Pieces(dict):
    """Piece of text to its ids, packed as 32-bit numbers."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        packed = np.array(merge_piece(piece.encode(), self.ranks), np.int32).tobytes()
        if len(piece) <= _LONG_PIECE:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed


def encode(
    df: DataFrame, rank_file: str, pattern: str, keep: Sequence[str] = ("doc_id",), text: str = "text", out: str = "ids"
) -> DataFrame:
    """The columns ``keep`` of every row, with the token ids of its whole text as ``out``.

    The rank file is read where the query is built and sent to the tasks, a megabyte or so whatever the data. A
    null or empty text has no ids. A column of ``keep`` named like ``out`` is replaced.
    """
    keep = [c for c in keep if c != out]
    with open(rank_file, "rb") as file:
        ranks_sent = df.sparkSession.sparkContext.broadcast(file.read())
    schema = T.StructType([*df.select(*keep).schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    texts, at = carry(df, keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        pieces = worker_memo(f"bpe:{rank_file}", lambda: _Pieces(read_ranks(ranks_sent.value)))
        cut = regex.compile(pattern).findall
        ids_of = pieces.__getitem__
        for batch in batches:
            whole = pc.fill_null(batch.column(at), "")
            packed = [b"".join(map(ids_of, cut(t.as_py()))) for t in whole]
            sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(packed), np.int32))
            ids = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], ids], [*keep, out])

    return texts.mapInArrow(run, schema)


def decode(
    df: DataFrame, rank_file: str, keep: Sequence[str] = ("doc_id",), ids: str = "ids", out: str = "decoded"
) -> DataFrame:
    """The columns ``keep`` of every row, with the bytes its ids stand for, one after another, as ``out``.

    Null ids give null; an id that is null or has no piece raises an error.
    """
    keep = [c for c in keep if c != out]
    with open(rank_file, "rb") as file:
        ranks_sent = df.sparkSession.sparkContext.broadcast(file.read())
    schema = T.StructType([*df.select(*keep).schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = {rank: part for part, rank in read_ranks(ranks_sent.value).items()}.__getitem__
        for batch in batches:
            column = batch.column(len(keep))
            whole = [None if x is None else b"".join(map(piece, x)) for x in _lists(column)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(whole, pa.binary())], [*keep, out])

    return df.select(*keep, df[ids].alias("_ids")).mapInArrow(run, schema)


class _Spelling:
    """The bytes of every id in one array, to spell many ids at once."""

    def __init__(self, ranks: dict[bytes, int]):
        parts = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            parts[rank] = piece
        self.size = np.array([len(p) for p in parts], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(parts), np.uint8)

    def spell(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        before = np.cumsum(size) - size
        return self.pool[np.repeat(self.start[ids] - before, size) + np.arange(int(size.sum()))].tobytes()


def encode_and_check(
    df: DataFrame, rank_file: str, pattern: str, keep: Sequence[str] = ("doc_id",), text: str = "text", out: str = "ids", digest: str = "decoded_sha256"
) -> DataFrame:
    """``encode``, and in the same pass over the texts the SHA-256, in lowercase hexadecimal, of the bytes that the ids decode to.

    The digest is made from the ids alone, as ``decode`` spells them. Columns of ``keep`` named like results are replaced.
    """
    keep = [c for c in keep if c not in (out, digest)]
    with open(rank_file, "rb") as file:
        ranks_sent = df.sparkSession.sparkContext.broadcast(file.read())
    added = [T.StructField(out, T.ArrayType(T.IntegerType())), T.StructField(digest, T.StringType())]
    schema = T.StructType([*df.select(*keep).schema.fields, *added])
    texts, at = carry(df, keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        def tables() -> tuple[_Pieces, _Spelling]:
            ranks = read_ranks(ranks_sent.value)
            return _Pieces(ranks), _Spelling(ranks)

        pieces, spelling = worker_memo(f"bpe-check:{rank_file}", tables)
        cut, ids_of = regex.compile(pattern).findall, pieces.__getitem__
        for batch in batches:
            packed, digests = [], []
            for t in pc.fill_null(batch.column(at), ""):
                ids = b"".join(map(ids_of, cut(t.as_py())))
                packed.append(ids)
                digests.append(hashlib.sha256(spelling.spell(np.frombuffer(ids, np.int32))).hexdigest())
            sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], ids, pa.array(digests, pa.string())], [*keep, out, digest])
        give_back()

    return texts.mapInArrow(run, schema)


def _lists(column: pa.Array) -> Iterator[list[int] | None]:
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    for known, low, high in zip(column.is_valid().to_pylist(), offsets[:-1], offsets[1:]):
        yield values[low:high].tolist() if known else None


def _rank_tables(ranks: dict[bytes, int]) -> tuple[Column, int]:
    """The ranks as one literal: small maps from a piece, in hexadecimal, to its rank, found by a checksum of the piece.

    A map literal is searched entry by entry, so one map of all pieces would make every look-up as long as the vocabulary.
    """
    many = 1 << max(1, (len(ranks) - 1).bit_length())
    tables: list[dict[str, int]] = [{} for _ in range(many)]
    for piece, rank in ranks.items():
        key = piece.hex().upper()
        tables[zlib.crc32(key.encode()) % many][key] = rank
    return F.from_json(F.lit(json.dumps(tables)), "array<map<string,int>>"), many


def merge_words(words: DataFrame, rank_file: str, word: str = "word", out: str = "ids") -> DataFrame:
    """``words``, one piece a row, with the ids of each: the ranked merges folded by higher-order functions.

    The built-in form of ``merge_piece``. Bytes are pairs of hexadecimal digits; one step of the fold merges the leftmost
    neighbours of lowest rank, until no neighbours have one. Null gives null, the empty piece no ids. It
    is right but slow; see the README for how slow.
    """
    with open(rank_file, "rb") as file:
        tables, many = _rank_tables(read_ranks(file.read()))

    def rank(piece: Column) -> Column:
        return F.element_at(F.get(tables, F.pmod(F.crc32(piece), F.lit(many)).cast("int")), piece)

    def step(parts: Column, _: Column) -> Column:
        pairs = F.zip_with(
            F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), F.slice(parts, 2, F.size(parts)), lambda a, b: F.concat(a, b)
        )
        costs = F.transform(pairs, lambda p, k: F.struct(rank(p).alias("rank"), k.alias("k"), p.alias("p")))
        best = F.array_min(F.filter(costs, lambda c: c["rank"].isNotNull()))

        def merged(low: Column) -> Column:
            joined = F.concat(F.slice(parts, 1, low["k"]), F.array(low["p"]), F.slice(parts, low["k"] + 3, F.size(parts)))
            return F.when(low.isNull(), parts).otherwise(joined)

        return F.get(F.transform(F.array(best), merged), F.lit(0))

    hexed = F.hex(F.encode(F.col(word), "UTF-8"))
    parts = F.regexp_extract_all(hexed, F.lit("(..)"), F.lit(1))
    steps = F.when(F.size(parts) > 1, F.sequence(F.lit(1), F.size(parts) - 1)).otherwise(F.array().cast("array<int>"))
    folded = F.aggregate(steps, parts, step)
    whole = rank(hexed)
    return words.withColumn(out, F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(folded, rank)))
