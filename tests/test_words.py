"""Trees of words, keyword tables and phrase conversion on fixtures."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from voxloom.functions import trie
from voxloom.operators import keywords, script_rows, word_parts


def brute_longest(text, table):
    out, at = [], 0
    while at < len(text):
        size = next((n for n in range(max(map(len, table), default=0), 0, -1) if text[at : at + n] in table), 0)
        out.append(table[text[at : at + size]] if size else text[at])
        at += max(size, 1)
    return "".join(out)


@pytest.mark.parametrize("seed", range(6))
def test_words_in_texts(seed):
    draw = random.Random(seed)
    letters = ["ab", "abc", "aé漢🙂", "abcdefghij"][seed % 4]
    words = sorted({"".join(draw.choices(letters, k=draw.randint(1, 6))) for _ in range(60)})
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 40))) for _ in range(50)] + ["", None]
    tree = trie.build([w.encode() for w in words])
    ((low, high, data, offsets),) = trie.blocks(pa.array(texts))
    row, word = trie.contained(tree, data, offsets)
    assert list(zip(row.tolist(), word.tolist())) == [(n, k) for n, t in enumerate(texts) for k, w in enumerate(words) if w in (t or "")]
    size = np.append(tree.size, 0)[trie.longest(tree, data, offsets)]
    at = trie.chosen(size, offsets)
    note = "<>".encode()
    new, ends = trie.replace(data, offsets, at, size[at], np.frombuffer(note, np.uint8), np.zeros(len(at), np.int64), np.full(len(at), 2))
    got = [new[a:b].tobytes().decode() for a, b in zip(ends, ends[1:])]
    assert got == [brute_longest(t or "", dict.fromkeys(words, "<>")) for t in texts]


def test_texts_never_share_a_word():
    tree = trie.build([b"ab", b"b", b"abab"])
    ((_, _, data, offsets),) = trie.blocks(pa.array(["a", "b", "xab", "ab"]))
    assert list(zip(*(x.tolist() for x in trie.contained(tree, data, offsets)))) == [(1, 1), (2, 0), (2, 1), (3, 0), (3, 1)]
    assert [len(x) for x in trie.contained(trie.build([]), data, offsets)] == [0, 0]
    sliced = pa.array(["zz", "ab", None, "abab"]).slice(1)
    assert [b[:2] for b in trie.blocks(sliced)] == [(0, 3)] and list(trie.blocks(pa.array([], pa.string()))) == []


def test_long_texts_in_blocks():
    texts = ["ab" * 700_000, "x", "ba" * 10, "b"]
    tree = trie.build([b"bab", b"ba", b"x", b"b" * 5000])
    found = [(low + r, w) for low, _, data, offsets in trie.blocks(pa.array(texts)) for r, w in zip(*(x.tolist() for x in trie.contained(tree, data, offsets)))]
    assert len(list(trie.blocks(pa.array(texts)))) > 1 and found == [(0, 0), (0, 1), (1, 2), (2, 0), (2, 1)]


@pytest.mark.parametrize("per", [2, 100])
def test_keyword_table(spark, per):
    listed = [("ab", 5), ("b", 2), ("ab", 3), ("", 9), (None, 1), ("漢字", 4), ("zz", 0), ("zz", None)]
    table = spark.createDataFrame(listed, "keyword string, kw_ord int").repartition(3)
    texts = [(1, "xabx"), (2, None), (3, ""), (4, "漢字ab"), (5, "漢"), (6, "b" * 3000), (7, "xabx")]
    df = spark.createDataFrame(texts, "row_id int, text string").repartition(2)
    best = {"ab": 3, "b": 2, "": 9, "漢字": 4, "zz": 0}
    want = sorted((n, w, best[w]) for n, t in texts if t is not None for w in best if w in t)
    got = keywords.keyword_table_matches(df, table, order="kw_ord", per=per)
    assert rows(got, "row_id", "keyword", "kw_ord") == sorted(want, key=repr)
    assert rows(keywords.keyword_table_matches(df, table, per=per), "row_id", "keyword") == sorted([w[:2] for w in want], key=repr)
    picked = keywords.select_by_keyword_table(df, table, cap=2, per=per)
    # Row 7 has the text of row 1; of "b" the first two rows are 1 and 4, of "" they are 1 and 3.
    assert rows(picked, "row_id", "keyword") == [(1, "b"), (3, ""), (4, "b")]
    counts = keywords.keyword_table_counts(df, table, cap=3, floor=2, per=per)
    assert rows(counts) == [("", 3, False), ("ab", 3, False), ("b", 3, False), ("zz", 0, True), ("漢字", 1, True)]
    none = table.limit(0)
    assert keywords.keyword_table_matches(df, none).count() == 0 and keywords.keyword_table_matches(df.limit(0), table).count() == 0
    assert keywords.keyword_table_counts(df.limit(0), table).agg(F.sum("n")).first()[0] == 0


def test_long_list_equals_short_list(spark):
    draw = random.Random(1)
    words = ["".join(draw.choices("abc", k=draw.randint(0, 4))) for _ in range(100)]
    df = spark.createDataFrame([(k, "".join(draw.choices("abcd", k=20))) for k in range(30)] + [(30, None), (31, "")], "row_id int, text string")
    want = sorted((r.row_id, n) for r in df.collect() if r.text is not None for n, w in enumerate(words) if w in r.text)
    assert sorted((r.row_id, r.kw_ord) for r in keywords.keyword_matches(df, words).collect()) == want


def test_parts_that_are_not_kept(spark, monkeypatch):
    table = spark.createDataFrame([(f"w{k}",) for k in range(300)], "keyword string")
    words = table.select(F.col("keyword").alias("word"), F.lit(None).cast("string").alias("note"), F.lit(0).alias("place"))
    folder = word_parts.write_parts(words, 40)
    monkeypatch.setattr(word_parts, "_KEEP", 5000)
    read = word_parts.part_reader(folder)
    for _ in range(2):
        parts = list(read())
        assert len(parts) == 8 and sorted(w for p in parts for w in p.words) == sorted(f"w{k}".encode() for k in range(300))
    # No job brings a keyword to the driver.
    assert len(spark.read.parquet(folder).inputFiles()) >= 1


def test_phrases(spark):
    table = [("头", "頭"), ("发", "發"), ("头发", "頭髮"), ("理发", "理髮"), ("发现", "發現"), ("皇后", "皇后"), ("后", "後"), ("理发店主", "X"), ("", "!"), (None, "!"), ("里", None), ("面", "麵"), ("面", "面")]
    phrases = spark.createDataFrame(table, "simplified string, traditional string")
    texts = ["头发发现", "理发店", "理发店主后", "皇后后面", "abc", "漢字头", "頭发", None, "", "a头b发\n里"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id int, text string").repartition(3)
    named: dict[str, str] = {}
    for a, b in table:
        if a and b is not None:
            named[a] = min(b, named.get(a, b))
    only = set("".join(named.values())) - set("".join(named))

    def want(text):
        han = text is not None and any("一" <= ch <= "鿿" for ch in text)
        if not han or only & set(text):
            return text, False
        return brute_longest(text, named), True

    for per in (3, 1000):
        got = script_rows.convert_phrases(df, "text", phrases, per)
        assert {r.row_id: (r.text, r.converted) for r in got.collect()} == {n: want(t) for n, t in enumerate(texts)}


def test_many_phrases(spark):
    draw = random.Random(3)
    han = [chr(0x4E00 + k) for k in range(400)]
    table = {"".join(draw.choices(han, k=draw.randint(1, 4))): "".join(draw.choices("xyz", k=draw.randint(0, 3))) for _ in range(100_000)}
    texts = ["".join(draw.choices([*han, "a", " "], k=300)) for _ in range(40)]
    phrases = spark.createDataFrame(list(table.items()), "simplified string, traditional string").repartition(4)
    got = script_rows.convert_phrases(spark.createDataFrame(list(enumerate(texts)), "k int, text string"), "text", phrases)
    assert {r.k: r.text for r in got.collect()} == {k: brute_longest(t, table) for k, t in enumerate(texts)}


def test_a_task_lets_out_few_matches_of_a_keyword(spark):
    """Texts come in order, so a task's first matches of a keyword are all that a cap can take; the trees shrink on the way."""
    import pyarrow as pa

    from voxloom.operators.word_parts import first_texts, write_parts

    words = ["", "a", "ab", "b", "zz", "éa"]
    listed = spark.createDataFrame([(w, None, k) for k, w in enumerate(words)], "word string, note string, place long")
    texts = [None if k % 11 == 0 else "ab" * (k % 3) + "é" * (k % 2) + "a" * (k % 5 == 0) + "zz" * (k == 37) for k in range(40)]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(range(low, low + 8)), pa.array([b"%d" % k for k in range(low, low + 8)]), pa.array(texts[low : low + 8], pa.string())], ["_order", "_text", "_col"])
        for low in range(0, 40, 8)
    ]
    for per in (2, 100):
        found = [r for b in first_texts(write_parts(listed, per), 3)(iter(batches)) for r in b.to_pylist()]
        want = [(w, at, k) for at, w in enumerate(words) for k in [n for n, t in enumerate(texts) if t is not None and w in t][:3]]
        assert sorted((r["keyword"], r["kw_ord"], r["_order"]) for r in found) == sorted(want)
        assert all(r["_text"] == b"%d" % r["_order"] for r in found)
