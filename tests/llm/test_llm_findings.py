"""Small cases of what a review found missing."""

import corpus_pipeline
from voxloom.llm import mixing, near_dedup, secret_scan

BEGIN, END = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
BODY = ["MIIE" + "aB3+/" * 12, "Zz09" * 16, "QUJD=="]


# --- secrets


def test_no_line_of_a_key_survives(spark):
    lines = "\n".join(BODY)
    cases = {
        f"before\n{BEGIN}\n{lines}\n{END}\nafter it": "before\n[secret]\nafter it",
        f"{BEGIN}\r\nProc-Type: 4,ENCRYPTED\r\nDEK-Info: AES-256-CBC,12\r\n\r\n" + "\r\n".join(BODY) + f"\r\n{END}": "[secret]",
        f"{BEGIN}\n{lines}\nplain words follow": "[secret]\nplain words follow",
        f"{BEGIN}\n{lines}": "[secret]",
        '{"key": "' + BEGIN + "\\n" + "\\n".join(BODY) + '\\n", "n": 1}': '{"key": "[secret]\\n", "n": 1}',
        f"{BEGIN}\n{BODY[0]}\n{BEGIN}\n{BODY[1]}\n{END}": "[secret]\n[secret]",
        f"the line {BEGIN} starts a key": "the line [secret] starts a key",
        f"{BEGIN}\npassword: hunter22\n{END} x": "[secret] x",
    }
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    assert {r.doc_id: r.text for r in secret_scan.redact(df).collect()} == dict(enumerate(cases.values()))
    for r in secret_scan.find_secrets(df, keep=("doc_id", "text")).collect():
        key = [s for s in r.secrets if s.kind == "private_key"]
        assert key and all(s.secret == r.text[s.start : s.end] for s in key)


# --- near copies


def test_one_row_of_each_group(spark):
    one, two, three = (" ".join(f"{x}{k}" for k in range(60)) for x in "pqr")
    rows = [(1, one, "a"), (2, one + " more", "b"), (2, two, "c"), (3, three, "d"), (3, three, "e"), (None, three, "f"), (None, two + " x", "g"), (None, None, "h"), (None, one[::-1], "i"), (None, one[::-1], "j")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row string").repartition(3)
    got = sorted((r.doc_id or 0, r.text or "") for r in corpus_pipeline.one_of_each(spark, df, "").collect())
    assert got == sorted([(1, one), (2, two), (3, three), (0, ""), (0, one[::-1])])
    marked = {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(df).filter("doc_id = 2").collect()}
    assert marked == {(2, 1), (2, 2)}


def test_repeated_rows_are_compared_once(spark, monkeypatch):
    seen = []
    compare = near_dedup._compare
    monkeypatch.setattr(near_dedup, "_compare", lambda placed, texts, *rest: seen.append((texts.join(placed, "doc").count(), placed.count())) or compare(placed, texts, *rest))
    text = " ".join(f"s{k}" for k in range(60))
    df = spark.createDataFrame([(1, text)] * 30 + [(2, text + " more")] * 30, "doc_id long, text string")
    got = near_dedup.near_duplicates(df).collect()
    assert seen == [(2, 2)] and len(got) == 60 and {r.component_id for r in got} == {1}


def test_pairs_at_the_threshold_meet(spark):
    """400 pairs of similarity 0.8 exactly, which share nothing with others."""
    rows = []
    for k in range(400):
        words = [f"p{k}w{n}" for n in range(100)]
        rows += [(2 * k, " ".join(words[:90])), (2 * k + 1, " ".join(words[10:]))]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=1)
    assert got.filter("component_id <> doc_id AND component_id = doc_id - 1").count() >= 396


# --- mixing


def test_copies_go_to_the_row_that_was_taken(spark):
    rows = [(None, f"{s} w{k} x y", s) for s, n in (("a", 4), ("b", 40), ("c", 400)) for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    want = {}
    for r in mixing.mix(df, block_words=50, depth=1).filter("copy IS NOT NULL").collect():
        want[r.source_size] = want.get(r.source_size, 0) + 1
    out = mixing.mixed_rows(df, block_words=50, depth=1)
    got = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert got == {s: want[4 * n] for s, n in (("a", 4), ("b", 40), ("c", 400)) if 4 * n in want}
    each = [r["count"] for r in out.groupBy("text").count().collect()]
    assert max(each) <= 3


def test_many_small_documents_fill_a_long_ones_place(spark):
    rows = [(k, "w " * 10, "a") for k in range(200)] + [(1000, "w " * 857, "a")] + [(2000 + k, "v " * 10, "b") for k in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    for seed in (0, 1, 2):
        taken, target = {}, {}
        for r in mixing.mix(df, weights=(1, 2), block_words=500, depth=1, seed=seed).collect():
            target[r.source_size] = r.target
            taken[r.source_size] = taken.get(r.source_size, 0) + (r["size"] if r.copy is not None else 0)
        assert all(abs(taken[k] - target[k]) <= 5 for k in target)
