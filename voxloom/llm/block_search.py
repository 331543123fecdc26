"""Nearest neighbours by a block matrix join on 8-bit codes.

Every vector is rounded to whole steps of its own, from -127 to 127, and keeps its norm, the norm of what was rounded off,
and the norm of what remained. Vectors are packed into blocks, codes beside originals, and written once. A block of queries
and a block of rows make a tile, a group of its own: the product of their codes gives all inner products at once, and

    |a.b - a'.b'|  <=  |a| |b - b'| + |a - a'| |b'|

bounds what rounding did to each. A pair is computed again from the originals only if its upper bound reaches the
k-th greatest lower bound seen, or the least of the query's heap of exact scores, which gets narrower from slice to slice. So
nothing that could be among the nearest is lost. The heaps of all tiles are merged by rank.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle
from .vectors import common_width, sound

BLOCK_ROWS = 8_192
BATCH_ROWS = 4_096
_SLICE = 1_024
_QUERIES = 256
_PAIRS = 1 << 15


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each row as 8-bit numbers, and per row: step, norm, norm rounded off, norm of the coded vector."""
    with np.errstate(over="ignore", invalid="ignore"):
        step = np.abs(vectors).max(1, initial=0) / 127
        code = np.rint(np.divide(vectors, step[:, None], out=np.zeros_like(vectors), where=step[:, None] > 0))
        code = np.clip(code, -127, 127)
        coded = code * step[:, None]
        # Parts of a billionth more than computed, so that rounding in the norms themselves is covered.
        norms = [np.sqrt((x * x).sum(1)) * (1 + 1e-9) for x in (vectors, vectors - coded, coded)]
    return code.astype(np.int8), np.stack([step, *norms], 1)


def exact_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products row by row, added from the first component to the last, so that equal rows score alike."""
    with np.errstate(over="ignore", invalid="ignore"):
        total = np.zeros(len(left))
        for a, b in zip(left.T, right.T):
            total += a * b
    # Infinities that cancel have no value, and come last.
    return np.where(np.isnan(total), -np.inf, total)


class Block:
    """Vectors with their keys and codes, as packed into one row."""

    def __init__(self, ids: bytes, codes: bytes, notes: bytes, vectors: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        rows = len(self.ids)
        self.codes = np.frombuffer(codes, np.int8).reshape(rows, -1)
        self.notes = np.frombuffer(notes).reshape(rows, 4)
        self.vectors = np.frombuffer(vectors).reshape(rows, -1)


PACKED = "ids binary, codes binary, notes binary, vectors binary"


def pack(ids: np.ndarray, vectors: np.ndarray) -> list[bytes]:
    codes, notes = encode(vectors)
    return [x.tobytes() for x in (ids, codes, notes, vectors)]


def tile(queries: Block, rows: Block, k: int) -> tuple[list[tuple[int, int, float]], int]:
    """(query, key, score) of the ``k`` nearest rows of each query, itself left out, and how many pairs were computed again."""
    # Products of codes are whole numbers; single precision holds them up to 1,040 components.
    kind = np.float32 if rows.codes.shape[1] * 127 * 127 < 1 << 24 else np.float64
    found, again = [], 0
    for at in range(0, len(queries.ids), _QUERIES):
        part = slice(at, at + _QUERIES)
        ids, codes, notes, vectors = (x[part] for x in (queries.ids, queries.codes, queries.notes, queries.vectors))
        codes = codes.astype(kind)
        step, norm, lost, _ = notes.T[:, :, None]
        heaps: list[list[tuple[float, int]]] = [[] for _ in ids]
        least = np.full(len(ids), -np.inf)
        for low in range(0, len(rows.ids), _SLICE):
            cut = slice(low, low + _SLICE)
            other = rows.notes[cut].T
            with np.errstate(over="ignore", invalid="ignore"):
                middle = (codes @ rows.codes[cut].astype(kind).T).astype(float) * step * other[0]
                reach = norm * other[2] + lost * other[3] + 1e-12 * norm * other[1]
                upper, lower = middle + reach, middle - reach
            # Beyond the range of doubles nothing is known, and all is computed again.
            wild = ~(np.isfinite(upper) & np.isfinite(lower))
            upper[wild], lower[wild] = np.inf, -np.inf
            own = ids[:, None] == rows.ids[cut]
            upper[own], lower[own] = -np.inf, -np.inf
            if lower.shape[1] > k:
                least = np.maximum(least, np.partition(lower, -k, 1)[:, -k])
            one, two = np.nonzero((upper >= least[:, None]) & ~own)
            again += len(one)
            for first in range(0, len(one), _PAIRS):
                p, q = one[first : first + _PAIRS], two[first : first + _PAIRS]
                scores = exact_scores(vectors[p], rows.vectors[cut][q])
                for n, score, key in zip(p.tolist(), scores.tolist(), rows.ids[cut][q].tolist()):
                    heap = heaps[n]
                    if len(heap) < k:
                        heapq.heappush(heap, (score, -key))
                    elif (score, -key) > heap[0]:
                        heapq.heapreplace(heap, (score, -key))
            for n, heap in enumerate(heaps):
                if len(heap) == k and heap[0][0] > least[n]:
                    least[n] = heap[0][0]
        found += [(query, -key, score) for query, heap in zip(ids.tolist(), heaps) for score, key in heap]
    return found, again


def _packed(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """``rows`` (id, v) packed by hash of the id into blocks of about ``size`` rows, and the number of blocks."""
    count = max(1, -(-rows.count() // size))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows of one block follow each other; a partition may hold several blocks.
        now, ids, vectors = None, [], []

        def close() -> pd.DataFrame:
            return pd.DataFrame([[now, *pack(np.concatenate(ids), np.concatenate(vectors))]], columns=[name, "ids", "codes", "notes", "vectors"])

        for frame in frames:
            for block, part in frame.groupby(name, sort=False):
                if now is not None and block != now:
                    yield close()
                    ids, vectors = [], []
                now = block
                ids.append(part["id"].to_numpy(np.int64))
                vectors.append(np.stack(part["v"].to_numpy()).astype(float))
        if now is not None:
            yield close()

    dealt = rows.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(count))).repartition(count, name).sortWithinPartitions(name)
    return settle(dealt.mapInPandas(run, f"{name} long, {PACKED}")), count


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` nearest rows for every query row, or all if fewer.

    Nearest is the largest inner product in double precision, ties to the smaller key; ``is_query`` is told by the key and
    other columns of a row. Rows with a null key, and vectors that are null, empty, all zero, of another length than the
    commonest, or hold a null or non-finite component, take no part. A repeated key counts once, by its least vector; it is
    a query if any of its rows is. An inner product beyond the range of doubles is infinite, and one that has no value
    comes last, as minus infinity.
    """
    good = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    good = good.filter(F.col("id").isNotNull() & sound(F.col("v")) & F.exists("v", lambda x: x != 0))
    good = good.filter(F.size("v") == common_width(good, "v")).withColumn("v", F.transform("v", lambda x: x.cast("double")))
    rows = settle(good.groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q")))
    blocks, n_blocks = _packed(rows.select("id", "v"), block_rows, "block")
    batches, n_batches = _packed(rows.filter("q").select("id", "v"), batch_rows, "batch")

    def every(name: str, count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint"))).alias(name)

    left = batches.select("*", every("block", n_blocks))
    right = blocks.select("*", every("batch", n_batches))

    def search(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(one) and len(two):
            queries, others = (Block(*x.iloc[0][["ids", "codes", "notes", "vectors"]]) for x in (one, two))
            found, _ = tile(queries, others, k)
        out = pd.DataFrame(found, columns=["query_id", "vec_id", "score"])
        return out.astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    tiles = left.groupBy("batch", "block").cogroup(right.groupBy("batch", "block"))
    best = tiles.applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
