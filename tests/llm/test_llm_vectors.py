"""Hard negatives, neighbours and whitening against brute force, and their cases of nulls, ties, repeats and widths."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import block_search, hard_negatives, vector_queries, whitening

SMALL = "/root/testdata/sf0.001"
CLASHES = "id v q u a n h label_ rank score walker anchor cluster batch part block bound low high x _x _c _s _r component whitened".split()


def frame(spark, rows, label=True):
    """(vec_id, embedding, label) with columns named like those inside the operators."""
    df = spark.createDataFrame([(k, None if v is None else [None if x is None else float(x) for x in v], c) for k, v, c in rows], "vec_id long, embedding array<double>, label int")
    return df.select("*", *[F.lit(f"old {c}").alias(c) for c in CLASHES])


def cloud(rng, n, width, groups=5):
    """Vectors in groups around centres, of unit length, some of them equal."""
    middle = rng.normal(size=(groups, width))
    v = middle[rng.integers(0, groups, n)] + 0.4 * rng.normal(size=(n, width))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[1::9] = v[:-1:9][: len(v[1::9])]
    return v


def brute_nearest(ids, v, queries, k):
    out = []
    for q in queries:
        s = np.cumsum(v * v[q], axis=1)[:, -1]
        order = [i for i in np.lexsort((ids, -s)) if i != q][:k]
        out += [(int(ids[q]), r + 1, int(ids[i]), float(s[i])) for r, i in enumerate(order)]
    return out


def brute_negatives(ids, labels, x, anchors, low=50, high=95):
    out = []
    for a in anchors:
        s = x @ x[a]
        order = np.lexsort((ids, -s))
        for p in [i for i in order if i != a and labels[i] == labels[a]][:5]:
            near = [i for i in order if labels[i] != labels[a] and low * s[p] <= 100 * s[i] <= high * s[p]][:3]
            out += [(int(ids[a]), int(ids[p]), r + 1, int(ids[i]), int(s[p]), int(s[i])) for r, i in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("name", sorted(vector_queries.ORACLES))
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    got = vector_queries.QUERIES[name](spark, SMALL)
    want = con.sql(vector_queries.ORACLES[name])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


# --- neighbours


def test_neighbours_over_tiles(spark):
    rng = np.random.default_rng(3)
    v = cloud(rng, 700, 24)
    df = frame(spark, [(k * 3, x, 0) for k, x in enumerate(v)]).repartition(5)
    got = block_search.nearest(df, F.pmod("vec_id", F.lit(20)) == 0, 7, block_rows=90, batch_rows=11)
    ids = np.arange(700) * 3
    assert sorted(map(tuple, got.collect())) == sorted(brute_nearest(ids, v, np.flatnonzero(ids % 20 == 0), 7))


def test_bounds_hold_and_spare_most_pairs():
    rng = np.random.default_rng(4)
    v = rng.normal(size=(3000, 64)) * rng.uniform(0.01, 100, (3000, 1))
    codes, notes = block_search.encode(v)
    step, norm, lost, coded = notes.T
    middle = (codes[:40].astype(float) @ codes.T) * step[:40, None] * step
    reach = norm[:40, None] * lost + lost[:40, None] * coded
    assert (np.abs(v[:40] @ v.T - middle) <= reach).all()
    one, many = (block_search.Block(*block_search.pack(np.arange(len(x)), x)) for x in (v[:40], v))
    found, again = block_search.tile(one, many, 5)
    assert again < 0.1 * 40 * 3000
    assert sorted((q, r, k, s) for q in range(40) for r, (s, k) in enumerate(sorted(((s, k) for p, k, s in found if p == q), key=lambda z: (-z[0], z[1])), 1)) == sorted(
        brute_nearest(np.arange(3000), v, range(40), 5)
    )


def test_neighbours_of_odd_rows(spark):
    same = [3.0, 4.0]
    rows = [
        (0, same, 1), (7, same, 1), (5, same, 1), (5, same, 2), (20, [1.0, 0.0], None), (20, [0.5, 0.0], 0), (40, None, 1), (60, [0.0, 0.0], 1),
        (80, [1.0, None], 1), (100, [float("nan"), 1.0], 1), (120, [float("inf"), 1.0], 1), (140, [], 1), (160, [1.0, 2.0, 3.0], 1),
        (None, same, 1), (180, [1e300, -1e300], 1), (8, [-1e300, 1e300], 1), (9, [1e300, 1e300], 1),
    ]
    got = {}
    for r in block_search.nearest(frame(spark, rows), F.pmod("vec_id", F.lit(20)) == 0, 4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == [0, 20, 180]
    assert sorted(got[0]) == [(1, 9, 7e300), (2, 8, 1e300), (3, 5, 25.0), (4, 7, 25.0)]
    # The repeated key 20 counts by its least vector, (0.5, 0).
    assert sorted(got[20]) == [(1, 9, 5e299), (2, 180, 5e299), (3, 0, 1.5), (4, 5, 1.5)]
    # inf - inf has no value; both lists end with what is worth least.
    assert [x[1:] for x in sorted(got[180])][:3] == [(20, 5e299), (0, -1e300), (5, -1e300)]
    none = frame(spark, rows).limit(0)
    assert block_search.nearest(none, F.col("vec_id") >= 0).count() == 0
    assert block_search.nearest(frame(spark, rows[:1]), F.col("vec_id") >= 0).count() == 0


# --- hard negatives


def test_negatives_over_clusters_and_parts(spark, monkeypatch):
    for name, value in (("PER_CLUSTER", 4), ("BATCH_WALKERS", 3), ("PART_ROWS", 60), ("SAMPLE", 100), ("_STEP", 16)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(5)
    v = cloud(rng, 600, 16)
    labels = rng.integers(0, 4, 600)
    df = frame(spark, [(k, x, int(c)) for k, (x, c) in enumerate(zip(v, labels))]).repartition(4)
    got = hard_negatives.hard_negatives(df, F.pmod("vec_id", F.lit(30)) == 0, F.col("label"))
    ids = np.arange(600)
    want = brute_negatives(ids, labels, np.floor(256 * v).astype(np.int64), ids[::30])
    assert len(want) > 50 and sorted(map(tuple, got.collect())) == want


def test_walks_end_early_and_miss_nothing():
    rng = np.random.default_rng(6)
    middle = rng.normal(size=(40, 32))
    rows = np.floor(200 * (middle[rng.integers(0, 40, 8000)] + 0.05 * rng.normal(size=(8000, 32))))
    u = np.floor(200 * (middle[:1] + 0.05 * rng.normal(size=(25, 32))))
    ids, labels = np.arange(8000), rng.integers(0, 2, 8000)
    centre = hard_negatives.centres(u, 1)
    angle = np.arccos(np.clip(hard_negatives.unit(u)[0] @ centre.T, -1, 1)).max(0)
    bound = hard_negatives.bounds(rows, centre, angle)[:, 0]
    scores = u @ rows.T
    assert (scores <= bound * np.linalg.norm(u, axis=1)[:, None] * (1 + 1e-9)).all()
    w = hard_negatives.Walkers(ids[:25], ids[:25] - 100, np.zeros(25, int), np.full(25, -(1 << 63)), np.full(25, (1 << 63) - 1), u, np.arange(25))
    found, scored = hard_negatives.walk(w, ids, labels, rows, bound, True, 6)
    assert scored < 0.5 * scores.size
    for n in range(25):
        best = np.lexsort((ids, -scores[n]))
        assert [(n, int(i), int(scores[n, i])) for i in best if labels[i] == 0][:6] == [f for f in found if f[0] == n]


def test_negatives_of_odd_rows(spark):
    x = [1.0, 0.0]
    rows = [
        (0, x, 1), (1, x, 1), (1, x, 1), (2, [0.9, 0.1], 2), (3, [0.9, 0.3], 2), (4, [0.5, 0.0], 2), (5, [0.49, 0.0], 2), (6, [0.95, 0.0], 2), (6, [0.96, 0.0], 3),
        (8, x, None), (9, None, 1), (10, [float("nan"), 0.0], 1), (11, [None, 1.0], 1), (12, [], 1), (13, [1.0], 1), (None, x, 1), (50, [0.0, 0.0], 1), (100, [-1.0, 0.0], 4), (16, [-0.5, 0.0], 4),
    ]
    df = frame(spark, rows)
    found = hard_negatives.hard_negatives(df, F.pmod("vec_id", F.lit(50)) == 0, F.col("label"))
    got = sorted(map(tuple, found.collect()))
    clean = [(k, v, c) for k, v, c in rows if k in (0, 2, 3, 4, 5, 50, 100, 16)] + [(1, x, 1), (6, [0.95, 0.0], 2)]
    ids, labels = (np.array([r[k] for r in clean]) for k in (0, 2))
    want = brute_negatives(ids, labels, np.floor(256 * np.array([r[1] for r in clean])).astype(np.int64), np.flatnonzero(ids % 50 == 0))
    assert got == want and {r[1] for r in got if r[0] == 0} >= {1}
    for empty in (df.limit(0), df.filter("vec_id = 0"), df.filter("vec_id IN (2, 3)")):
        assert hard_negatives.hard_negatives(empty, F.pmod("vec_id", F.lit(50)) == 0, F.col("label")).count() == 0
    # Components and scores far beyond 64 bits.
    big = frame(spark, [(0, [1e300, 1.0], 1), (1, [1e300, 1.0], 1), (2, [1e300, 2.0], 2), (3, [7e8, 2.0], 2)])
    far = hard_negatives.hard_negatives(big, F.col("vec_id") == 0, F.col("label"))
    assert [(r.positive_id, r.negative_id, r.positive_score) for r in far.collect()] == []


# --- whitening


def matrix_product(a):
    return lambda block: a @ block


@pytest.mark.parametrize("width,count", [(1, 3), (5, 16), (40, 3), (120, 6), (200, 16)])
def test_leading_pairs(width, count):
    rng = np.random.default_rng(width)
    q = np.linalg.qr(rng.normal(size=(width, width)))[0]
    for values in (np.sort(rng.uniform(0, 9, width))[::-1], np.repeat(5.0, width), np.where(np.arange(width) < 2, 3.0, 0.0), 1 + 1e-3 * np.arange(width)[::-1]):
        a = (q * values) @ q.T
        vectors, found, residual = whitening.leading_pairs(matrix_product((a + a.T) / 2), width, count)
        k = min(width, count)
        assert vectors.shape == (width, k) and residual < 1e-11
        assert np.allclose(found, np.sort(values)[::-1][:k], atol=1e-12, rtol=1e-12)
        assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)


def test_correction_equation():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(30, 30))
    a = a @ a.T
    basis = np.linalg.qr(rng.normal(size=(30, 4)))[0]
    theta = np.array([3.0, 50.0])
    right = rng.normal(size=(30, 2))
    right -= basis @ (basis.T @ right)
    t = whitening.minres(matrix_product(a), basis, theta, right, 40)
    image = a @ t - t * theta
    assert np.allclose(basis.T @ t, 0, atol=1e-9) and np.allclose(image - basis @ (basis.T @ image), right, atol=1e-6)


def check_white(rows, got, scale=64, shift=1_000_000):
    """Results of all rows against exact sums and a dense eigendecomposition."""
    x = {k: [math.floor(scale * c) + shift for c in v] for k, v in rows}
    fit = sorted(set(map(tuple, x.values())))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    z = np.array(fit) - shift - (np.array(sums) - n * shift) / n
    values = np.linalg.eigvalsh(z.T @ z / n)[::-1]
    count = max(r["component"] for r in got)
    assert count == min(16, int((values > 1e-9 * values[0]).sum()))
    white = {}
    for r in got:
        assert r["n"] == n and r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x[r["vec_id"]], sums))
        assert abs(r["explained"] / (values[r["component"] - 1] / values.sum()) - 1) < 1e-9 and r["identity_error"] < 1e-9
        white.setdefault(r["vec_id"], {})[r["component"]] = r["whitened"]
    assert len(white) == len(x)
    w = np.array([[white[next(k for k in x if tuple(x[k]) == f)][c + 1] for c in range(count)] for f in fit])
    assert np.allclose(w.T @ w / n, np.eye(count), atol=1e-9)
    # Whitened columns are combinations of the centred vectors along eigenvectors: V (V w) = e w.
    for c in range(count):
        u = np.linalg.lstsq(z, w[:, c], rcond=None)[0]
        assert np.allclose(z.T @ (z @ u) / n, values[c] * u, atol=1e-9 * values[0] * np.linalg.norm(u))


def test_whitening_of_a_table(spark):
    rng = np.random.default_rng(8)
    v = cloud(rng, 400, 24)
    got = whitening.whiten(frame(spark, [(k, x, 0) for k, x in enumerate(v)]).repartition(6)).collect()
    assert len(got) == 400 * 16
    check_white(list(enumerate(v)), got)


def test_partial_sums_in_two_levels(spark):
    rng = np.random.default_rng(9)
    v = rng.normal(size=(300, 5))
    df = spark.createDataFrame([(x.tolist(),) for x in v], "x array<double>").repartition(100)
    assert df.rdd.getNumPartitions() > whitening._FAN
    data = whitening._Rows(df, 300, np.zeros(5), np.zeros(5))
    assert np.allclose(data.product(np.eye(5)), v.T @ v / 300)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(10)
    flat = rng.normal(size=(30, 3)) @ rng.normal(size=(3, 6))
    # Whole numbers after scaling keep the rank.
    flat = np.round(flat * 4) / 64
    good = [(k, x, 0) for k, x in enumerate(flat)] + [(k + 30, x, 0) for k, x in enumerate(flat[:10])]
    bad = [(90, None, 0), (91, [1.0] * 5 + [None], 0), (92, [float("nan")] * 6, 0), (93, [float("-inf")] * 6, 0), (94, [], 0), (95, [1.0], 0)]
    got = whitening.whiten(frame(spark, good + bad)).collect()
    assert {r["vec_id"] for r in got} == set(range(40))
    check_white([(k, v) for k, v, _ in good], got)
    again = {r["component"]: r["whitened"] for r in got if r["vec_id"] == 3}
    assert again == {r["component"]: r["whitened"] for r in got if r["vec_id"] == 33}
    # Null and repeated keys stay, each a row of its own.
    odd = whitening.whiten(frame(spark, [(None, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (1, [3.0, 2.0], 0), (1, [3.0, 2.0], 0)])).collect()
    assert sorted((r["vec_id"] or 0, abs(round(r["whitened"], 9))) for r in odd) == [(0, 1.0), (1, 1.0), (1, 1.0), (1, 1.0)]
    # Nothing to scale: no rows, one vector, equal vectors.
    for few in (good[:0], bad, good[:1], [(1, [2.0, 3.0], 0), (2, [2.0, 3.0], 0)]):
        assert whitening.whiten(frame(spark, few)).count() == 0
    # Deviations beyond 64 bits are null, entries beyond 52 bits are held there.
    big = whitening.whiten(frame(spark, [(1, [1e300, 0.0], 0), (2, [-1e300, 1.0], 0), (3, [5.0, 0.5], 0)])).collect()
    assert {r["vec_id"] for r in big} == {1, 2, 3} and all(math.isfinite(r["whitened"]) for r in big)
    assert {r["deviation"] for r in big if r["vec_id"] != 3} == {None}
