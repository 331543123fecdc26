"""Hard negatives by shared lists of anchor clusters, after the MAXIMUS index for maximum inner products.

Anchors are clustered by direction. With the angle t between a row and the centre of a cluster, and the widest angle w
between the centre and an anchor of the cluster, no anchor u of it scores more than

    |u| |row| cos(max(0, t - w))

on that row. So a cluster sorts all rows once by |row| cos(max(0, t - w)), and each of its anchors walks that
list from the top until its k-th best score, or the least score it may take, is above all that is left.

A list is cut into stretches at bounds that a sample of rows puts at a sixteenth, a quarter and all of the list, and
a stretch into parts of bounded size. A round gives each cluster its next stretch, but only if an anchor of the cluster is not
certified yet; parts are sorted and walked by tasks of their own, and the best of all parts are merged before the next
round. The sample decides where lists are cut, never what is found.

Two walks make hard negatives: one over rows of an anchor's own label gives its positives; one over the other
labels, once for each positive, takes only scores within that positive's range.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle
from .vectors import common_width, floors, matrix, one_per_key, sound

# Anchors for which one more cluster is made, the most clusters, and the anchors and rows that lists are cut by.
PER_CLUSTER = 512
MOST_CLUSTERS = 1_024
SAMPLE = 8_192
# Walkers and rows of one task.
BATCH_WALKERS = 4_096
PART_ROWS = 16_384
STRETCHES = (1 / 16, 1 / 4)
_STEP = 512

WALKER = "walker long, anchor long, label long, low long, high long, cluster int, u array<double>"
FOUND = "walker long, id long, score long"


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and norms; a zero vector has the zero direction."""
    norm = np.sqrt((vectors * vectors).sum(1))
    return np.divide(vectors, norm[:, None], out=np.zeros_like(vectors), where=norm[:, None] > 0), norm


def centres(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means of a sample, from its first distinct directions; empty clusters go."""
    rays = unit(sample)[0]
    rays = rays[(rays != 0).any(1)]
    if not len(rays):
        return np.zeros((1, sample.shape[1]))
    _, first = np.unique(rays, axis=0, return_index=True)
    found = rays[np.sort(first)[:count]]
    for _ in range(rounds):
        near = (rays @ found.T).argmax(1)
        total = np.zeros_like(found)
        np.add.at(total, near, rays)
        found = unit(total)[0]
        found = found[(found != 0).any(1)]
        if not len(found):
            return rays[:1]
    return found


def bounds(vectors: np.ndarray, centre: np.ndarray, widest: np.ndarray) -> np.ndarray:
    """For each row and cluster, what no anchor of the cluster scores above, in parts of the anchor's norm."""
    rays, norm = unit(vectors)
    angle = np.arccos(np.clip(rays @ centre.T, -1, 1))
    # A millionth of a radian and a billionth of the norm more than computed, for rounding.
    away = np.maximum(0, angle - widest - 1e-6)
    return norm[:, None] * (np.cos(np.minimum(away, np.pi)) + 1e-9)


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held in doubles: exact, and cut to 64 bits."""
    most = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(1, left.shape[1])
    if most < 2.0**53:
        return (left @ right.T).astype(np.int64)
    full = np.array([[sum(int(a) * int(b) for a, b in zip(x, y)) for y in right] for x in left], object).reshape(len(left), len(right))
    return np.clip(full, -(1 << 63), (1 << 63) - 1).astype(np.int64)


@dataclass
class Walkers:
    """Those that walk one list: distinct anchors, and for each walker its anchor, label and range of scores."""

    ids: np.ndarray
    anchors: np.ndarray
    labels: np.ndarray
    low: np.ndarray
    high: np.ndarray
    vectors: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, frame: pd.DataFrame) -> Walkers:
        anchors = frame["anchor"].to_numpy(np.int64)
        _, first, place = np.unique(anchors, return_index=True, return_inverse=True)
        vectors = np.stack([frame["u"].iloc[k] for k in first]).astype(float)
        return cls(*(frame[c].to_numpy(np.int64) for c in ("walker", "anchor", "label", "low", "high")), vectors, place)


def walk(w: Walkers, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, bound: np.ndarray, same: bool, k: int) -> tuple[list[tuple[int, int, int]], int]:
    """(walker, id, score) of the ``k`` best rows within each walker's range, and how many scores were computed.

    ``low`` of a walker is a score it must reach; with ``same`` rows share its label, else they do not. A row is never met by
    the anchor that it is.
    """
    order = np.argsort(-bound, kind="stable")
    norm = np.sqrt((w.vectors * w.vectors).sum(1)) * (1 + 1e-9)
    least = w.low.astype(float)
    best: list[list[tuple[int, int]]] = [[] for _ in w.ids]
    scored = 0
    for at in range(0, len(order), _STEP):
        part = order[at : at + _STEP]
        # All that is left is bounded by the first of the step; certified walkers stop here.
        top = bound[part[0]] * norm
        live = np.flatnonzero((top + np.abs(top) * 1e-9)[w.place] >= least)
        if not len(live):
            break
        used, row = np.unique(w.place[live], return_inverse=True)
        scores = exact_products(w.vectors[used], vectors[part])[row]
        scored += scores.size
        fits = (labels[part] == w.labels[live, None]) == same
        fits &= (scores >= least[live, None]) & (scores <= w.high[live, None]) & (ids[part] != w.anchors[live, None])
        for n in np.flatnonzero(fits.any(1)).tolist():
            mine, of = int(live[n]), part[fits[n]]
            pairs = best[mine] + list(zip((-scores[n, fits[n]]).tolist(), ids[of].tolist()))
            best[mine] = sorted(pairs)[:k]
            if len(best[mine]) == k:
                least[mine] = max(least[mine], -best[mine][-1][0])
    return [(walker, key, -score) for walker, found in zip(w.ids.tolist(), best) for score, key in found], scored


@dataclass(frozen=True)
class Lists:
    """The clusters of anchors: centres, widest angles, and for each cluster where its list is cut, and how much of it lies above."""

    centre: np.ndarray
    widest: np.ndarray
    cuts: np.ndarray
    above: np.ndarray
    rows: int


def _sample(df: DataFrame, column: str, size: int) -> np.ndarray:
    """The vectors of the ``size`` rows whose key has the least hash."""
    got = df.select(column, F.xxhash64("id").alias("_h"), "id").orderBy("_h", "id").limit(size).select(column).toPandas()
    return np.stack(got[column]).astype(float) if len(got) else np.zeros((0, 0))


def make_lists(rows: DataFrame, anchors: DataFrame) -> tuple[Lists, DataFrame]:
    """The lists for ``anchors`` over ``rows``, both (id, label, v), and the anchors with their ``cluster``.

    Centres and cuts come from ``SAMPLE`` anchors and rows at most; widest angles from all anchors.
    """
    total, count = rows.count(), anchors.count()
    clusters = max(1, min(MOST_CLUSTERS, -(-count // PER_CLUSTER)))
    centre = centres(_sample(anchors, "v", max(SAMPLE, 4 * clusters)), clusters)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rays, norm = unit(matrix(batch.column(2)))
                cosine = np.clip(rays @ centre.T, -1, 1)
                near = cosine.argmax(1)
                # A zero vector scores 0 everywhere and needs no angle.
                angle = np.where(norm > 0, np.arccos(cosine[np.arange(len(near)), near]), 0.0)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32)), pa.array(angle)], ["id", "label", "v", "cluster", "angle"])

    placed = settle(anchors.select("id", "label", "v").mapInArrow(assign, "id long, label long, v array<double>, cluster int, angle double"))
    widest = np.zeros(len(centre))
    for r in placed.groupBy("cluster").agg(F.max("angle").alias("a")).collect():
        widest[r["cluster"]] = r["a"]
    sample = _sample(rows, "v", SAMPLE)
    values = np.sort(bounds(sample, centre, widest), axis=0)[::-1]
    at = [min(len(values) - 1, int(len(values) * share)) for share in STRETCHES]
    cuts = np.concatenate([values[at], np.full((1, len(centre)), -np.inf)])
    above = np.stack([(values >= cut).mean(0) for cut in cuts])
    return Lists(centre, widest, cuts, above, total), placed


def _stretch(rows: DataFrame, lists: Lists, n: int, live: dict[int, int]) -> DataFrame:
    """Stretch ``n`` of the list of each cluster in ``live``, in parts, for each of the batches that ``live`` counts."""
    centre, widest = lists.centre, lists.widest
    low = lists.cuts[n]
    high = lists.cuts[n - 1] if n else np.full(len(centre), np.inf)
    share = lists.above[n] - (lists.above[n - 1] if n else 0)
    parts = np.maximum(1, np.ceil(share * lists.rows / PART_ROWS)).astype(np.int64)
    names = ["cluster", "batch", "part", "id", "label", "v", "bound"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bound = bounds(matrix(batch.column(2)), centre, widest)
            # The first stretch has no upper end: its rows may be as high as they like.
            inside = (bound >= low) & (bound < high) if n else bound >= low
            for cluster, many in live.items():
                at = np.flatnonzero(inside[:, cluster])
                if not len(at):
                    continue
                taken = batch.take(pa.array(at))
                part = (batch.column(3).to_numpy()[at] % parts[cluster]).astype(np.int32)
                for b in range(many):
                    same = [pa.array(np.full(len(at), x, np.int32)) for x in (cluster, b)]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(part), *taken.columns[:3], pa.array(bound[at, cluster])], names)

    hashed = rows.select("id", "label", "v", F.pmod(F.xxhash64("id"), F.lit(1 << 31)).alias("h"))
    return hashed.mapInArrow(run, "cluster int, batch int, part int, id long, label long, v array<double>, bound double")


def search(rows: DataFrame, lists: Lists, walkers: DataFrame, same: bool, k: int) -> DataFrame:
    """``walker``, ``id``, ``score``: the ``k`` best rows of each walker; see ``WALKER`` for the columns that walkers have."""
    walkers = settle(walkers)
    best = None
    rank = Window.partitionBy("walker").orderBy(F.desc("score"), "id")
    norm = F.sqrt(F.aggregate("u", F.lit(0.0), lambda a, x: a + x * x))
    last = len(lists.cuts) - 1

    def met(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(one) and len(two):
            ids, labels, bound = (two[c].to_numpy() for c in ("id", "label", "bound"))
            found, _ = walk(Walkers.of(one), ids, labels, np.stack(two["v"]).astype(float), bound, same, k)
        return pd.DataFrame(found, columns=["walker", "id", "score"]).astype("int64")

    live = walkers
    for n in range(last + 1):
        counts = {r["cluster"]: r["n"] for r in live.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not counts:
            break
        batches = {c: -(-many // BATCH_WALKERS) for c, many in counts.items()}
        many = F.element_at(_literal_map(batches), F.col("cluster"))
        share = lists.above[n] - (lists.above[n - 1] if n else 0)
        parts = {c: int(max(1, np.ceil(share[c] * lists.rows / PART_ROWS))) for c in counts}
        dealt = live.withColumn("batch", F.pmod(F.xxhash64("anchor"), many).cast("int")).withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.element_at(_literal_map(parts), F.col("cluster")) - 1))
        )
        keys = ["cluster", "batch", "part"]
        stretch = _stretch(rows, lists, n, batches)
        found = dealt.groupBy(*keys).cogroup(stretch.groupBy(*keys)).applyInPandas(met, FOUND)
        every = found if best is None else best.unionByName(found)
        best = settle(every.withColumn("_r", F.row_number().over(rank)).filter(F.col("_r") <= k).drop("_r"))
        if n == last:
            break
        # Certified: as many rows as wanted, the least of which is above all that is left; or nothing left is good enough.
        kth = best.groupBy("walker").agg(F.count(F.lit(1)).alias("_c"), F.min("score").alias("_s"))
        edge = F.element_at(_literal_map({c: float(lists.cuts[n][c]) for c in range(len(lists.centre))}), F.col("cluster"))
        top = edge * norm
        reach = top + F.abs(top) * 1e-6 + 1e-6
        joined = walkers.join(kth, "walker", "left").withColumn("_least", F.when(F.col("_c") == k, F.greatest("low", "_s")).otherwise(F.col("low")))
        live = settle(joined.filter(reach >= F.col("_least")).withColumn("low", F.col("_least")).select(*walkers.columns))
    return best if best is not None else walkers.sparkSession.createDataFrame([], FOUND)


def _literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in sorted(values.items()) for x in pair])


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 3,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    percent: tuple[int, int] = (50, 95),
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score.

    Scores are inner products of floor(scale * x). The positives of an anchor are its best ``positives`` other rows of
    the same label; for each of them the best ``negatives`` rows of another label whose score is from ``percent[0]`` to ``percent[1]``
    per cent of the positive's, ends included. Higher scores come first, ties by smaller key; where there are fewer, all.
    A positive of negative score has no such range and no result.

    Rows with a null key or label, and vectors that are null, empty, of another length than the commonest, or hold a null or
    non-finite component, take no part. A repeated key counts once, by its least label and then vector; it is an anchor
    if that row is. Components are held within 52 bits and scores within 64.
    """
    good = df.select(F.col(key).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(vector).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("a"))
    good = good.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & sound(F.col("v")))
    good = good.filter(F.size("v") == common_width(good, "v")).withColumn("v", floors(F.col("v"), scale))
    rows = settle(one_per_key(good, "id", "label", "v", "a"))
    spark = df.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if rows.filter("a").isEmpty():
        return spark.createDataFrame([], schema)
    rows = rows.select("id", "label", "v", "a")
    lists, anchors = make_lists(rows, rows.filter("a"))
    nothing, everything = F.lit(-(1 << 63)), F.lit((1 << 63) - 1)
    first = anchors.select(F.col("id").alias("walker"), F.col("id").alias("anchor"), "label", nothing.alias("low"), everything.alias("high"), "cluster", F.col("v").alias("u"))
    near = search(rows, lists, first, True, positives)
    near = settle(near.select(F.col("walker").alias("anchor"), F.col("id").alias("positive"), "score", F.monotonically_increasing_id().alias("walker")))
    low, high = percent
    # The least whole number of at least low per cent, the greatest of at most high per cent; no overflow in decimals.
    wide = F.col("score").cast("decimal(20,0)")
    limits = F.ceil(wide * low / 100).cast("bigint").alias("low"), F.floor(wide * high / 100).cast("bigint").alias("high")
    pairs = near.select("walker", F.col("anchor").alias("id"), *limits).join(anchors.select("id", "label", "cluster", "v"), "id")
    second = pairs.filter("low <= high").select("walker", F.col("id").alias("anchor"), "label", "low", "high", "cluster", F.col("v").alias("u"))
    far = search(rows, lists, second, False, negatives).withColumnRenamed("score", "negative_score")
    order = Window.partitionBy("walker").orderBy(F.desc("negative_score"), "id")
    joined = far.withColumn("rank", F.row_number().over(order)).join(near.withColumnRenamed("score", "positive_score"), "walker")
    return joined.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"), "positive_score", "negative_score")
