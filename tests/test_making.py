"""New rows out of old ones: combination, overtalk, backchannels, word times, segmentation, augmentation."""

import itertools
import random
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from voxloom.operators import augment, combine, segmentation, sentences, split_tables
from voxloom.plans import prepare_training, sanity_check

TIMED = "audio_filepath string, pos int, word string, start double, end double"


def test_join_neighbours(spark):
    df = spark.createDataFrame(
        [("s", 1, "a", 10.0, "one"), ("s", 5, "b", 12.0, "two"), ("s", 9, "c", 20.0, "three"), ("t", 2, "d", 20.0, "x"), ("t", 3, "e", 11.0, "y")],
        "source string, row_id long, audio_filepath string, duration double, text string",
    )
    kept, rejects = combine.join_neighbours(df)
    assert rows(kept) == [("s", 0, "a", "b", 22.0, "one two")]
    assert rows(rejects, "first_path", "reason") == [("c", "no_partner"), ("d", "long")]


def test_backchannels(spark):
    df = spark.createDataFrame([("f", 0, "hi", 0.0, 0.4), ("f", 1, "there", 1.4, 1.8), ("f", 2, "now", 1.9, 2.0)], TIMED)
    made = combine.insert_backchannels(df, [("okay", 0.3)])
    assert rows(combine.text_of_words(made)) == [("f", "hi okay there now")]
    added = made.filter("inserted").first()
    assert abs(added.start - 0.75) < 1e-9 and abs(added.end - 1.05) < 1e-9


def test_overtalk(spark):
    data = [(f"f{n}", p, f"w{n}{p}", float(p), p + 0.5) for n in range(20) for p in range(3)]
    df = spark.createDataFrame(data, TIMED)
    kept, alone = combine.overtalk(df, seed=1)
    plan = kept.collect()
    used = [p for r in plan for p in (r.first_path, r.second_path)]
    assert plan and len(used) == len(set(used))
    assert sorted(used + [r.audio_filepath for r in alone.collect()]) == sorted(f"f{n}" for n in range(20))
    for r in plan:
        assert 0 <= r.overlap <= 1 and abs(r.second_start - (2.5 - r.overlap)) < 1e-9
        assert sorted(r.text.split()) == sorted(f"w{p[1:]}{k}" for p in (r.first_path, r.second_path) for k in range(3))
    assert sorted(plan) == sorted(combine.overtalk(df.repartition(5), seed=1).kept.collect())


def test_word_times(spark):
    truth = spark.createDataFrame([("f", "a b c d"), ("g", "x")], "audio_filepath string, text string")
    timed = spark.createDataFrame([("f", 0, "a", 0.0, 0.5), ("f", 1, "x", 0.6, 0.9), ("f", 2, "c", 1.0, 1.5)], TIMED)
    assert rows(combine.word_times(truth, timed), "audio_filepath", "pos", "word", "op", "start") == [
        ("f", 0, "a", "OK", 0.0), ("f", 1, "b", "SUB", 0.6), ("f", 2, "c", "OK", 1.0), ("f", 3, "d", "DEL", None), ("g", 0, "x", "DEL", None)
    ]


def every_split(token, counts, pairs, total):
    """Best split by trying all."""

    def alone(w):
        return counts[w] / total if w in counts else 10.0 / (total * 10 ** len(w))

    best = None
    for cuts in itertools.product([0, 1], repeat=len(token) - 1):
        parts, word = [], token[0]
        for ch, cut in zip(token[1:], cuts):
            parts, word = (parts + [word], ch) if cut else (parts, word + ch)
        parts.append(word)
        score = log10(alone(parts[0]))
        for a, b in zip(parts, parts[1:]):
            n = pairs.get(f"{a} {b}") if a in counts else None
            score += log10(n / total / alone(a)) if n else log10(alone(b))
        if best is None or score > best[0] + 1e-9:
            best = (score, parts)
    return best


def test_best_split_equals_search():
    random.seed(9)
    vocabulary = ["a", "ab", "b", "ba", "abc", "c", "ca", "bc"]
    for _ in range(150):
        counts = {w: random.randint(1, 50) for w in random.sample(vocabulary, 5)}
        pairs = {f"{a} {b}": random.randint(1, 20) for a in counts for b in counts if random.random() < 0.3}
        token = "".join(random.choices("abc", k=random.randint(1, 8)))
        score, _ = every_split(token, counts, pairs, 200.0)
        parts = segmentation.best_split(token, counts, pairs, 200.0)
        assert "".join(parts) == token
        total = log10(counts[parts[0]] / 200 if parts[0] in counts else 10.0 / (200 * 10 ** len(parts[0])))
        for a, b in zip(parts, parts[1:]):
            n = pairs.get(f"{a} {b}") if a in counts else None
            first = counts[a] / 200 if a in counts else 10.0 / (200 * 10 ** len(a))
            second = counts[b] / 200 if b in counts else 10.0 / (200 * 10 ** len(b))
            total += log10(n / 200 / first) if n else log10(second)
        assert abs(total - score) < 1e-6


def test_segment_latin(spark):
    corpus = spark.createDataFrame([("buy usd now",)] * 5, "text string")
    counts, pairs = segmentation.word_counts(corpus), segmentation.word_pair_counts(corpus)
    df = spark.createDataFrame([(1, "buyusd"), (2, "买buyUSD吧 1"), (3, "Buyusd"), (4, "买 吧"), (5, "買，")], "row_id long, text string")
    got = dict(rows(segmentation.segment_latin(df, counts, pairs), "row_id", "text"))
    assert got == {1: " buy usd", 2: " 买 buy usd 吧 1", 3: " Buyusd", 4: " 买吧", 5: " 買，"}
    assert rows(segmentation.segment_latin(df, counts), "text") == rows(segmentation.segment_latin(df, counts, pairs), "text")


@pytest.mark.parametrize("per", [3, 1000])
def test_tokens_split_together(spark, monkeypatch, per):
    monkeypatch.setattr(split_tables.write_words, "__defaults__", (per,))
    monkeypatch.setattr(split_tables.write_pairs, "__defaults__", (per,))
    monkeypatch.setattr(segmentation, "_LETTERS", 50)
    draw = random.Random(4)
    vocabulary = sorted({"".join(draw.choices("ab1", k=draw.choice([1, 2, 2, 3, 5, 13, 24]))) for _ in range(20)})
    counts = {w: draw.choice([1, 2, 9]) for w in vocabulary[::2] + vocabulary[1::4]}
    pairs = {f"{a} {b}": draw.choice([1, 3]) for a in vocabulary for b in vocabulary if draw.random() < 0.4}
    tokens = sorted({"".join(draw.choices(vocabulary, k=draw.randint(1, 9))) for _ in range(40)} | {"", "zz" * 30, "a" * 200})
    got = segmentation.token_splits(
        spark.createDataFrame([(t,) for t in tokens], "token string"),
        spark.createDataFrame([*counts.items(), ("é", 4)], "word string, n long"),
        spark.createDataFrame([*pairs.items()], "pair string, n long"),
    )
    # No substring of a token is a row.
    assert "Generate" not in got._jdf.queryExecution().toString()
    total = float(sum(counts.values()) + 4)
    want = []
    for t in tokens:
        inside = {p: n for p, n in pairs.items() if p.replace(" ", "") in t}
        want.append((t, " ".join(segmentation.best_split(t, {w: n for w, n in counts.items() if w in t}, inside, total))))
    assert rows(got, "token", "words") == sorted(want, key=repr)


def test_spoken_form(spark):
    df = spark.createDataFrame([("佢哋喺度",), ("他們是的",), ("無",)], "text string")
    assert rows(sentences.spoken_form(df, ["佢", "喺"], ["他們", "是"])) == [("佢哋喺度",), ("無",)]


def clips(spark, n=400):
    random.seed(1)
    data = [(f"k{i}", [random.uniform(-0.5, 0.5) for _ in range(200)], 100, "some text", i % 500) for i in range(n)]
    return spark.createDataFrame(data, "key string, samples array<float>, sampling_rate int, text string, labels_length int")


def test_augment(spark):
    noise = spark.createDataFrame([(i, [0.1 * (i + 1), -0.2] * 30) for i in range(3)], "noise_id long, noise_samples array<float>")
    base = clips(spark)
    noisy = augment.assign_noise(base, noise, "key")
    assert noisy.count() == 400 and noisy.select("noise_id").distinct().count() == 3
    done = augment.augment(noisy, "key").withColumnRenamed("samples", "made").join(base.select("key", "samples"), "key").collect()
    kinds = {"background": 0, "gaussian": 0, "neither": 0}
    for r in done:
        x, y = np.array(r.samples, dtype=float) * r.gain, np.array(r.made, dtype=float)
        if r.snr_db is not None:
            kinds["background"] += 1
            level = 20 * np.log10(np.sqrt(np.mean(x**2)) / np.sqrt(np.mean((y - x) ** 2)))
            assert 1 <= r.snr_db <= 2 and abs(level - r.snr_db) < 1e-3
        elif r.sigma is not None:
            kinds["gaussian"] += 1
            assert 0.6 < np.std(y - x) / r.sigma < 1.4
        else:
            kinds["neither"] += 1
            assert np.allclose(x, y, atol=1e-6)
    assert 130 < kinds["background"] < 230 and 50 < kinds["gaussian"] < 110
    assert 20 < sum(r.gain != 1 for r in done) < 65
    again = augment.augment(noisy.repartition(3), "key")
    assert rows(again, "key", "samples") == rows(augment.augment(noisy, "key"), "key", "samples")
    assert spark.createDataFrame([([0.5, -0.25],)], "x array<double>").select(augment.invert(F.col("x"))).first()[0] == [-0.5, 0.25]


def test_prepare_training(spark):
    noise = spark.createDataFrame([(0, [0.1, -0.2])], "noise_id long, noise_samples array<float>")
    base = clips(spark, 100).withColumn("text", F.when(F.col("key") == "k1", "x").otherwise(F.col("text")))
    kept, bad = prepare_training(base, noise, key="key", max_labels=90)
    per = {(r["split"], r["variant"]): r["count"] for r in kept.unionByName(bad.drop("reason")).groupBy("split", "variant").count().collect()}
    assert per[("train", "original")] == per[("train", "augmented")] and ("test", "augmented") not in per
    assert set(r.reason for r in bad.collect()) <= {"label_length", "blank"}
    assert kept.filter("input_length <> 2.0").count() == 0


def test_sanity_check(spark):
    df = spark.createDataFrame([("a", "One two, three!", "one (um) two three"), ("b", "x y", "q r"), ("c", "!", "z"), ("d", "a b", "a c")], "audio_filepath string, ref string, hyp string")
    scored, accepted, empty = sanity_check(df)
    assert rows(scored, "audio_filepath", "error") == [("a", 0.0), ("b", 1.0), ("d", 0.5)]
    assert rows(accepted, "audio_filepath") == [("a",)] and rows(empty, "audio_filepath", "reason") == [("c", "empty_ref")]
