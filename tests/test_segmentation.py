"""Latin runs split together: cutting over bytes, the search with many and with few texts, tables in parts, keys that repeat."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from voxloom.functions import runs, splits
from voxloom.functions.text import space_scripts
from voxloom.operators import segmentation, split_tables

ODD = [
    None, "", " ", "ab", "Ab c", "汉", "汉a", "a汉", "a汉b 1", "汉<p>a", "<p>汉a</p>", "汉 <p> a", "</p><p>", "a<p", "<</p>>x汉", "中文USD交易spot",
    "\U00020000x\U00020001Y", "a\U00020000", "\U00020000a", "汉\U00020000a汉", "xK汉", "K", "İstanbul", "aİ汉", "İ汉", "é汉é", "1汉2", "汉12", "line\nbreak\t汉x", "〇a々b", "カa", "ß汉ß", "a 汉", "İ", "x。汉，y",
]


def test_runs_equal_spacing(spark):
    df = spark.createDataFrame([*enumerate(ODD)], "row_id long, text string")
    spaced = space_scripts(F.replace("text", F.lit(" "), F.lit("")))
    low = F.lower("run")
    want = df.select("row_id", F.split(spaced, " ").alias("runs"), spaced.rlike("^[a-z]").alias("low"))
    want = want.select("row_id", F.posexplode("runs").alias("pos", "run"), ((F.size("runs") > 1) | F.col("low")).alias("go"))
    want = want.select("row_id", "pos", "run", F.when(F.col("go") & low.rlike("[a-z]"), F.regexp_replace(low, "[^a-z0-9]", "")).alias("token"))
    is_han = np.zeros(1 << 21, bool)
    for first, last in segmentation._han(spark).tolist():
        is_han[first : last + 1] = True
    got = runs.runs(pa.array(["left out", *ODD]).slice(1), is_han)
    token = got.tokens.take(pa.array(got.token, mask=got.token < 0)).to_pylist()
    place = np.arange(len(got.of_text)) - np.searchsorted(got.of_text, got.of_text)
    assert sorted(zip(got.of_text.tolist(), place.tolist(), got.whole.to_pylist(), token), key=repr) == rows(want, "row_id", "pos", "run", "token")


def test_only_two_capitals_have_plain_letters():
    plain = [c for c in map(chr, range(128, 0x110000)) if any("0" <= x <= "9" or "a" <= x <= "z" for x in c.lower())]
    assert plain == ["İ", "K"]


def test_counts_equal_expressions(spark, monkeypatch):
    monkeypatch.setattr(segmentation, "_TEXT", 40)
    texts = [*ODD, "The cat the CAT", "one", "a b a b a", "x" * 60 + " y", "KelvinK İx y"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    found = df.select(F.regexp_extract_all(F.lower("text"), F.lit("([a-z0-9]+)"), F.lit(1)).alias("w"))
    want: dict = {}
    pairs: dict = {}
    for (words,) in found.collect():
        for w in words or []:
            want[w] = want.get(w, 0) + 1
        for a, b in zip(words or [], (words or [])[1:]):
            pairs[f"{a} {b}"] = pairs.get(f"{a} {b}", 0) + 1
    assert dict(rows(segmentation.word_counts(df))) == want
    assert dict(rows(segmentation.word_pair_counts(df))) == pairs


@pytest.mark.parametrize("narrow", [0, 3, 1000])
@pytest.mark.parametrize("per", [5, 1000])
def test_search_equals_best_split(spark, monkeypatch, narrow, per):
    monkeypatch.setattr(splits, "_NARROW", narrow)
    monkeypatch.setattr(splits, "_BLOCK", 17)
    monkeypatch.setattr(splits, "_PAIRS", 30)
    monkeypatch.setattr(split_tables.write_words, "__defaults__", (per,))
    monkeypatch.setattr(split_tables.write_pairs, "__defaults__", (per,))
    draw = random.Random(narrow + per)
    vocabulary = sorted({"".join(draw.choices("ab", k=draw.choice([1, 1, 2, 2, 3, 4, 12, 13, 24]))) for _ in range(24)})
    counts = {w: draw.choice([1, 1, 2, 4]) for w in vocabulary[::2] + vocabulary[1::4]}
    pairs = {f"{a} {b}": draw.choice([1, 2]) for a in vocabulary for b in vocabulary if draw.random() < 0.3}
    tokens = sorted({"".join(draw.choices(vocabulary, k=draw.randint(1, 12))) for _ in range(60)} | {"", "b" * 90, "ab" * 70})
    split = segmentation._splitter(
        spark.createDataFrame([*counts.items()], "word string, n long"), spark.createDataFrame([*pairs.items()], "pair string, n long")
    )
    got = dict(zip(tokens, split(pa.array(tokens)).to_pylist()))
    total = float(sum(counts.values()))
    for t in tokens:
        inside = {p: n for p, n in pairs.items() if p.replace(" ", "") in t}
        assert got[t] == " ".join(segmentation.best_split(t, {w: n for w, n in counts.items() if w in t}, inside, total))


def test_tables_are_opened_once(spark, monkeypatch):
    """However large they are; tables over a limit were read again for each stretch of texts."""
    words = split_tables.write_words(spark.createDataFrame([(f"w{i}", i + 1) for i in range(100)], "word string, n long"), 7)
    opened, whole = [], split_tables._mapped
    monkeypatch.setattr(split_tables, "_mapped", lambda *at: opened.append(at) or whole(*at))
    find, may = split_tables.word_finder(words), split_tables.word_filter(words)
    asked = [f"w{i}".encode() for i in range(120)]
    data, size = np.frombuffer(b"".join(asked), np.uint8), np.array([len(w) for w in asked])
    low, high = splits.word_codes(data, np.cumsum(size), size)
    for _ in range(3):
        number, n = find(low, high)
        assert n.tolist() == [i + 1 if i < 100 else -1 for i in range(120)] and len(set(number[:100].tolist())) == 100
        assert may(low, high)[:100].all()
    assert len(opened) == 2 * len({name for name, entries, _ in words.parts if entries})


def test_no_run_is_a_row(spark):
    corpus = spark.createDataFrame([("buy usd now",)] * 5, "text string")
    df = spark.createDataFrame([(1, "买buyusd", 7), (2, None, 8), (None, "买buyusd", 9)], "row_id long, text string, other int")
    got = segmentation.segment_latin(df, segmentation.word_counts(corpus), segmentation.word_pair_counts(corpus))
    plan = got._jdf.queryExecution().toString()
    assert "Generate" not in plan and "Join" not in plan
    assert got.columns == ["row_id", "other", "text"]
    assert rows(got) == sorted([(1, 7, " 买 buy usd"), (2, 8, None), (None, 9, None)], key=repr)


def test_rows_that_share_a_key(spark):
    """They get one text, by the place of their runs."""
    corpus = spark.createDataFrame([("buy usd now",)] * 5, "text string")
    df = spark.createDataFrame([(1, "买buyusd"), (1, "买Now"), (1, None), (2, "buyusd"), (3, None), (3, None)], "row_id long, text string")
    got = segmentation.segment_latin(df, segmentation.word_counts(corpus))
    assert rows(got) == [(1, " 买 买 buy usd now")] * 3 + [(2, " buy usd"), (3, None), (3, None)]
