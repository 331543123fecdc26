import random
import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from voxloom.functions import edits
from voxloom.operators import alignment
from voxloom.operators.alignment import align, confusions, distance, trace_ops
from voxloom.operators.filters import below_rate
from voxloom.operators.scoring import best_checkpoint, macro_scores, micro_cer, pair, pair_cer, pending_work, score_words


def table_model(ref, hyp):
    """Plain edit table with a walk back from its corner."""
    n, m = len(ref), len(hyp)
    cost = [[max(i, j) if 0 in (i, j) else 0 for j in range(m + 1)] for i in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            near = (cost[i - 1][j - 1], cost[i][j - 1], cost[i - 1][j])
            cost[i][j] = near[0] if ref[i - 1] == hyp[j - 1] else 1 + min(near)
    ops, i, j = [], n, m
    while i or j:
        if i and j and ref[i - 1] == hyp[j - 1]:
            i, j, op = i - 1, j - 1, "OK"
        elif i and j and cost[i][j] == cost[i - 1][j - 1] + 1:
            i, j, op = i - 1, j - 1, "SUB"
        elif j and cost[i][j] == cost[i][j - 1] + 1:
            j, op = j - 1, "INS"
        else:
            i, op = i - 1, "DEL"
        ops.append((op, None if op == "INS" else ref[i], None if op == "DEL" else hyp[j]))
    return ops[::-1]


words = st.lists(st.sampled_from("abcd"), max_size=14)


@settings(max_examples=400, deadline=None)
@given(words, words, st.sampled_from([1, 3, 256]))
def test_walk_equals_table(ref, hyp, block):
    kept, alignment._BLOCK = alignment._BLOCK, block
    try:
        want = table_model(ref, hyp)
        assert [(o["op"], o["ref"], o["hyp"]) for o in trace_ops(ref, hyp)] == want
        assert distance(ref, hyp) == sum(op != "OK" for op, _, _ in want)
    finally:
        alignment._BLOCK = kept


def test_long_texts_need_little_memory():
    random.seed(5)
    ref = [str(random.randrange(900)) for _ in range(6000)]
    hyp = [w for w in ref if random.random() > 0.1]
    assert distance(ref, hyp) == len(ref) - len(hyp)
    assert sum(o["op"] == "DEL" for o in trace_ops(ref, hyp)) == len(ref) - len(hyp)


def frame(spark, pairs):
    return spark.createDataFrame([(i, r.split(), h.split()) for i, (r, h) in enumerate(pairs)], "id int, ref_words array<string>, hyp_words array<string>")


def test_counts_and_rates(spark):
    got = score_words(frame(spark, [("a b c d", "a x c"), ("a b", "b a"), ("", "a"), ("a", "")])).orderBy("id").collect()
    assert [(r.cor, r["sub"], r.ins, r["del"]) for r in got] == [(2, 1, 0, 1), (0, 2, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1)]
    assert [r.wer for r in got] == [50.0, 100.0, None, 100.0]
    assert [r.reason for r in got] == [None, None, "empty_ref", None]


def test_count_laws(spark):
    random.seed(2)
    pairs = [(" ".join(random.choices("abc", k=random.randrange(9))), " ".join(random.choices("abc", k=random.randrange(9)))) for _ in range(200)]
    df = align(frame(spark, pairs)).withColumn("m", F.size("hyp_words"))
    assert df.filter("cor + sub + del <> ref_len OR cor + sub + ins <> m").count() == 0
    assert rows(df.drop("m")) == rows(align(frame(spark, pairs).repartition(5)))


def test_confusions(spark):
    assert rows(confusions(frame(spark, [("a b c d", "a x c"), ("a", "a")]))) == [
        ("DEL", "d", None, 1), ("OK", "a", "a", 2), ("OK", "c", "c", 1), ("SUB", "b", "x", 1)
    ]
    assert confusions(frame(spark, [("a b c d", "a x c"), ("a", "a")]), k=1).collect()[0].n == 2


def test_cer(spark):
    df = spark.createDataFrame([("c1", "中文", "中国"), ("c1", "abcd", "abcd"), ("c2", "", "x"), ("c2", None, "x")], "checkpoint string, ref string, hyp string")
    assert [r.cer for r in pair_cer(df).orderBy("checkpoint", "ref").collect()] == [0.0, 0.5, None, None]
    assert rows(micro_cer(df.filter("ref <> ''"))) == [("c1", 1 / 6)]
    wild = spark.createDataFrame([("kitten é", "sitting e"), ("", "abc"), ("x" * 90, "y" * 70)], "a string, b string")
    assert wild.filter(F.levenshtein("a", "b") != alignment.char_distance(F.col("a"), F.col("b"))).count() == 0


def test_pair_keeps_repeated_references(spark):
    refs = spark.createDataFrame([("a", "one"), ("a", "one"), ("b", "two")], "audio_filepath string, text string")
    heard = spark.createDataFrame([("c1", "a", "x"), ("c2", "a", "y")], "checkpoint string, audio_filepath string, hyp string")
    assert rows(pair(refs, heard)) == [("a", "one", "c1", "x")] * 2 + [("a", "one", "c2", "y")] * 2
    assert rows(pending_work(["c1", "c2"], refs, heard.filter("checkpoint = 'c1'"))) == [("c1", "b"), ("c2", "a"), ("c2", "b")]


def test_best_checkpoint_ties_go_by_natural_order(spark):
    macro = spark.createDataFrame([("checkpoint-1000", 90.0, 10.0, 0.2), ("checkpoint-200", 90.0, 12.0, 0.1)], "checkpoint string, avg_cor double, avg_wer double, cer double")
    assert rows(best_checkpoint(macro, cer="cer")) == [("checkpoint-200", "checkpoint-1000", "checkpoint-200")]


def test_macro_rounds_each_file_first(spark):
    df = frame(spark, [("a b c", "a b x"), ("a", "a")]).withColumn("checkpoint", F.lit("c"))
    got = macro_scores(score_words(df)).first()
    assert got.avg_wer == (0.333 * 100 + 0) / 2 and got.n_files == 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(["a", "b", "c", None]), max_size=150), st.lists(st.sampled_from(["a", "b", "d", None]), max_size=150)), max_size=30), st.sampled_from([1, 2, 16]), st.sampled_from([1 << 12, 1 << 25]))
def test_pairs_together_equal_pairs_alone(pairs, few, room):
    kept = edits.FEW, edits.ROOM
    edits.FEW, edits.ROOM = few, room
    try:
        ref, hyp = (pa.array([p[k] for p in pairs] + [None, []], pa.list_(pa.string())) for k in (0, 1))
        both = [(r or [], h or []) for r, h in zip(ref.to_pylist(), hyp.to_pylist())]
        assert alignment.ops_batch(ref, hyp).to_pylist() == [trace_ops(r, h) for r, h in both]
        counts = [tuple([o["op"] for o in trace_ops(r, h)].count(op) for op in ("OK", "SUB", "INS", "DEL")) for r, h in both]
        assert [tuple(c.values()) for c in alignment.count_batch(ref, hyp).to_pylist()] == counts
        texts = [tuple("".join(w or "漢" for w in side) for side in p) for p in both]
        found = alignment._distances(*edits.text_sequences(*(pa.array([t[k] for t in texts], pa.string()) for k in (0, 1))))
        assert found.tolist() == [distance(r, h) for r, h in texts]
    finally:
        edits.FEW, edits.ROOM = kept


def test_many_pairs_do_not_step_one_by_one(monkeypatch):
    """Character distances and moves of pairs of like size share their steps; confusions leave a group of pairs counted."""
    words = [f"{k % 7} x{k % 3} y {'z ' * (k % 5)}w" for k in range(400)]
    heard = [w.replace("x1", "u").replace("z z", "z") for w in words]
    alone = []
    monkeypatch.setattr(alignment, "distance", lambda r, h: alone.append(1) or 0)
    monkeypatch.setattr(alignment, "walk", lambda r, h: alone.append(1) or iter(()))
    alignment._distances(*edits.text_sequences(pa.array(words), pa.array(heard)))
    lists = [pa.array([w.split() for w in side], pa.list_(pa.string())) for side in (words, heard)]
    alignment.ops_batch(*lists)
    found = list(alignment._confused([pa.RecordBatch.from_arrays(lists, ["ref", "hyp"])]))
    assert not alone
    assert sum(b.num_rows for b in found) < 100 < 400 < sum(sum(b.column(3).to_pylist()) for b in found)


def test_batch_of_moves_needs_little_memory():
    """Moves are arrays, not objects; what Python allocates for a batch stays near what it returns."""
    lists = [pa.array([[f"w{(k * j + s) % 50}" for j in range(80)] for k in range(2000)], pa.list_(pa.string())) for s in (0, 1)]
    alignment.ops_batch(*lists)
    tracemalloc.start()
    alignment.ops_batch(*lists)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2000 * 80 * 2 * 8 * 12 + 3 * edits.ROOM


def heard(text, letters, share):
    """``text`` with about this share of its letters changed, left out or said twice."""
    out = []
    for c in text:
        k = random.random() / share
        out.append(c if k > 1 else random.choice(letters) if k > 0.6 else "" if k > 0.3 else c + c)
    return "".join(out)


def test_bands_give_the_distance_and_tell_what_is_above_a_limit(monkeypatch):
    """Near texts, texts with a part moved, and texts without relation, of several blocks; with a limit, only what is above it may differ."""
    random.seed(11)
    for letters, room in (("ab", 1 << 25), ("abcdefgh é", 1 << 25), ("abc漢字", 1 << 12)):
        monkeypatch.setattr(edits, "ROOM", room)
        refs = ["".join(random.choices(letters, k=random.choice([0, 3, 64, 65, 200, 700]))) for _ in range(120)]
        hyps = [heard(r, letters, random.choice([0.01, 0.05, 0.3, 1])) if k % 4 else r[len(r) // 3 :] + r[: len(r) // 3] for k, r in enumerate(refs)]
        want = [distance(r, h) for r, h in zip(refs, hyps)]
        both = edits.text_sequences(pa.array(refs), pa.array(hyps))
        assert alignment._distances(*both).tolist() == want
        most = [random.choice([-1, 0, 1, len(r) // 20 + 1, w - 1, w, w + 1, 1 << 40]) for r, w in zip(refs, want)]
        found = alignment._distances(*both, np.array(most)).tolist()
        assert all(f == w if w <= m else f > m for f, w, m in zip(found, want, most))


def test_a_limit_leaves_out_pairs_and_most_of_the_table(monkeypatch):
    """Pairs whose letters tell that they are above the limit are not stepped, and the others only in a band of that width."""
    random.seed(12)
    letters = "abcdefghijklmnopqrst "
    refs = ["".join(random.choices(letters, k=1500)) for _ in range(200)]
    hyps = [r.translate({97: "x", 98: "y"}) if k % 2 else heard(r, letters, 0.02) for k, r in enumerate(refs)]
    seen, step = [], edits.columns
    monkeypatch.setattr(edits, "columns", lambda ref, hyp, rows, within=None: seen.append((set((rows % 2).tolist()), len(rows), within.max())) or step(ref, hyp, rows, within))
    alignment._distances(*edits.text_sequences(pa.array(refs), pa.array(hyps)), np.full(200, 60))
    assert seen == [({0}, 100, 60)]


def test_cer_below_keeps_the_same_rows(spark):
    random.seed(13)
    texts = ["".join(random.choices("abcdef ", k=random.choice([1, 20, 40, 300]))) for _ in range(150)]
    both = [(k, r, heard(r, "abcdef ", random.choice([0.02, 0.1, 0.5]))) for k, r in enumerate(texts)] + [(-1, "", "a"), (-2, None, "a"), (-3, "a", None), (-4, "", ""), (-5, "漢字", "漢字")]
    df = spark.createDataFrame(both, "id int, ref string, hyp string")
    for t in (0.0, 0.05, 0.1, 0.5, 1.0, 5.0):
        kept = rows(below_rate(pair_cer(df), "cer", t).kept)
        assert rows(below_rate(pair_cer(df, below=t), "cer", t).kept) == kept
        assert below_rate(pair_cer(df, below=t), "cer", t).rejects.count() == len(both) - len(kept)
    assert 0 < len(rows(below_rate(pair_cer(df, below=0.05), "cer", 0.05).kept)) < len(both)
