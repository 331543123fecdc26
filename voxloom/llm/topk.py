"""Exact top-k search by inner product with vector-approximation files.

Vectors are dealt into blocks, and a block is a file of approximations: every component is kept as the number of a
cell, sixteen a dimension. A search scans the cells, which bound each inner product from above and below, and then
reads exact vectors from the highest bound down until the k-th best exact score is above every bound left. The best
of every block are merged.

Queries meet blocks in batches of bounded size: each pair of a query batch and a block is one group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 8_192
BATCH_ROWS = 2_048
CELLS = 16
# Products of longer components, or sums of more of them, might leave 64 bits and are computed with Python numbers.
_SAFE = 1 << 24


def integer_vector(c: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component; null if the vector or a component is null or not finite."""
    good = c.isNotNull() & F.forall(c, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.when(good, F.transform(c, lambda x: F.floor(x.cast("double") * scale)))


def cells(vectors: np.ndarray, count: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell numbers of all components, and the least and greatest value of each (dimension, cell)."""
    marks = np.quantile(vectors, np.arange(1, count) / count, axis=0, method="lower")
    code = np.stack([np.searchsorted(marks[:, d], vectors[:, d], "right") for d in range(vectors.shape[1])], 1).astype(np.uint8)
    low = np.zeros((vectors.shape[1], count), vectors.dtype)
    high = np.zeros_like(low)
    for d in range(vectors.shape[1]):
        for c in np.unique(code[:, d]):
            inside = vectors[code[:, d] == c, d]
            low[d, c], high[d, c] = inside.min(), inside.max()
    return code, low, high


def search_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> list[tuple]:
    """(query, id, score) of the ``k`` best of one block for each query, ties to the smaller id, itself left out."""
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    width = vectors.shape[1] if vectors.size else 0
    big = max(np.abs(queries).max(initial=0), np.abs(vectors).max(initial=0)) >= _SAFE or width > 1 << 14
    kind = object if big else np.int64
    if not big:
        code, low, high = cells(vectors)
        dims = np.arange(width)
        # The scan reads cells only: the bounds of a component lie at the ends of its cell.
        least, greatest = low[dims, code].astype(float), high[dims, code].astype(float)
    out = []
    for at in range(0, len(queries), 256):
        part = queries[at : at + 256]
        if not big:
            plus, minus = np.maximum(part, 0).astype(float), np.minimum(part, 0).astype(float)
            upper = plus @ greatest.T + minus @ least.T
            lower = plus @ least.T + minus @ greatest.T
        for q in range(len(part)):
            mine = ids != query_ids[at + q]
            if big:
                near = np.flatnonzero(mine)
                scores = vectors[near].astype(kind) @ part[q].astype(kind) if len(near) else np.zeros(0, kind)
                found = [(s, n) for s, n in zip(scores, near)]
            else:
                candidates = np.flatnonzero(mine)
                bound = upper[q, candidates]
                if len(candidates) > k:
                    # At least k rows score this much, so nothing bounded below it can be among the best.
                    sure = np.partition(lower[q, candidates], -k)[-k]
                    candidates, bound = candidates[bound >= sure], bound[bound >= sure]
                visit = np.argsort(-bound, kind="stable")
                found, done, step = [], 0, 4 * k
                while done < len(visit):
                    chunk = candidates[visit[done : done + step]]
                    found += zip((vectors[chunk] @ part[q]).tolist(), chunk.tolist())
                    done, step = done + step, step * 2
                    found = sorted(found, key=lambda x: (-x[0], x[1]))[:k]
                    if done < len(visit) and len(found) == k and bound[visit[done]] < found[-1][0]:
                        break
            for score, n in sorted(found, key=lambda x: (-x[0], x[1]))[:k]:
                out.append((int(query_ids[at + q]), int(ids[n]), max(-(1 << 63), min((1 << 63) - 1, int(score)))))
    return out


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 1024,
    block_rows: int = BLOCK_ROWS,
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` best rows for every query row, or all if fewer.

    Score: inner product of the integer vectors, ties to the smaller key. Rows with a null key, or a vector that is
    null, empty or holds a null or non-finite component, take no part. Vectors meet only those of their length. Rows
    equal in key and vector count once; a query never meets rows of its own key. Scores beyond 64 bits are cut to 64.
    """
    rows = df.select(F.col(key).cast("bigint").alias("id"), integer_vector(F.col(vector), scale).alias("v"), is_query.alias("q"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).withColumn("n", F.size("v"))
    rows = rows.dropDuplicates(["id", "v"])
    counted = rows.agg(F.count(F.lit(1)), F.sum(F.when(F.col("q"), 1).otherwise(0))).first()
    blocks = max(1, -(-counted[0] // block_rows))
    batches = max(1, -(-(counted[1] or 0) // batch_rows))
    spread = F.xxhash64("id", "v")
    vectors = rows.select("id", "v", "n", F.pmod(spread, F.lit(blocks)).alias("block")).withColumn(
        "batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1)).cast("array<bigint>"))
    )
    queries = rows.filter("q").select("id", "v", "n", F.pmod(spread, F.lit(batches)).alias("batch")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>"))
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            found = search_block(np.stack(left["v"]), left["id"].to_numpy(), np.stack(right["v"]), right["id"].to_numpy(), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    keys = ["n", "block", "batch"]
    best = queries.groupBy(*keys).cogroup(vectors.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # A key with several vectors keeps its best as a candidate.
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
