"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from voxloom.llm import bpe, fingerprints, licenses, mixing, near_dedup, queries, secret_scan, sharding, substring_dedup, topk, toxicity

# Names that operators use inside or for results, all of them columns of the input here.
CLASHES = "slot shard secrets row size order copy block doc node label a b n key task side score licenses ids decoded lanes edited text_ _id _x _source _key data bucket nodes".split()
LONG = " ".join(f"w{k % 977}x{k}" for k in range(60_000))


def rows():
    near = " ".join(f"near{k}" for k in range(60))
    out = [
        (1, "alpha beta gamma delta epsilon", "en", "s1", 30),
        (2, None, None, None, None),
        (3, "", "en", "s1", 0),
        (4, " \t\n ", "en", "", 4),
        (5, LONG, "en", "s2", len(LONG)),
        (6, LONG, "en", "s2", len(LONG)),
        (7, near, "de", "s3", len(near)),
        (8, near + " tail", "de", None, len(near) + 5),
        (9, "ÄÖ é 漢字 🙂 token = abcdef1234\npassword: hunter22 AKIA" + "Z" * 16, "de", "s3", 60),
        (9, "ÄÖ é 漢字 🙂 token = abcdef1234\npassword: hunter22 AKIA" + "Z" * 16, "de", "s3", 60),
        (None, near, "de", "s3", len(near)),
        (None, None, None, None, None),
        (12, "Released under the MIT License. alpha", "en", "s1", 36),
        (13, "x", "en", "s4", 1),
    ]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long")
    return plain.select("*", *[F.lit(f"old {c}").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def none(spark, docs):
    return spark.createDataFrame([], docs.schema)


def test_sharding(docs, none):
    names = [f"n{k}" for k in range(5)]
    placed = sharding.place(docs, names, slots=503)
    assert placed.count() == 14 and placed.columns.count("shard") == 1
    assert set(docs.columns) <= set(placed.columns)
    got = placed.select("doc_id", "text", "slot", "shard").collect()
    assert all(0 <= r.slot < 503 and 0 <= r.shard < 5 for r in got)
    assert len({r.shard for r in got if r.doc_id == 9}) == 1
    assert sharding.place(none, names).count() == 0


def test_secrets(docs, none):
    found = secret_scan.find_secrets(docs, keep=("doc_id", "text", "secrets", "row")).collect()
    assert len(found) == 14
    for r in found:
        assert [s.kind for s in r.secrets] == (["assign", "assign", "access"] if r.doc_id == 9 else [])
        for s in r.secrets:
            assert s.secret in r.text[s.start : s.end]
    clean = secret_scan.redact(docs)
    assert clean.columns == docs.columns
    texts = {(r.doc_id, r.text) for r in clean.collect()}
    assert (9, "ÄÖ é 漢字 🙂 [secret]\n[secret] [secret]") in texts and (2, None) in texts and (5, LONG) in texts
    assert secret_scan.find_secrets(none).count() == 0 and secret_scan.redact(none).count() == 0


def test_mixing(docs, none):
    mixed = mixing.mix(docs, block_words=500, depth=2)
    got = mixed.collect()
    assert len({r.row for r in got}) == 14
    taken = {}
    for r in got:
        taken[r.row] = taken.get(r.row, 0) + (r.size if r.copy is not None else 0)
        assert taken[r.row] <= 3 * r.size
    again = {(r.doc_id, r["size"], r.copy, r.shard) for r in mixing.mix(docs, block_words=500, depth=2).collect()}
    assert again == {(r.doc_id, r["size"], r.copy, r.shard) for r in got}
    rows_out = mixing.mixed_rows(docs, block_words=500, depth=2)
    assert [c for c in rows_out.columns if c not in ("shard", "order")] == [c for c in docs.columns if c not in ("shard", "order")]
    assert rows_out.count() == sum(r.copy is not None for r in got)
    assert mixing.mix(none).count() == 0 and mixing.mixed_rows(none).count() == 0


def test_near_dedup(docs, none):
    got = near_dedup.near_duplicates(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    by_id = {r.doc_id: r for r in got.filter("doc_id IS NOT NULL").collect()}
    assert got.count() == 14
    assert by_id[6].component_id == 5 and not by_id[6].kept and by_id[5].kept
    assert by_id[8].component_id == 7 and not by_id[8].kept
    assert [by_id[k].n_shingles for k in (1, 2, 3, 4, 13)] == [1, 0, 0, 0, 1]
    assert all(by_id[k].component_id == k and by_id[k].kept for k in (1, 2, 3, 4, 9, 12, 13))
    assert all(r.component_id is None and r.kept for r in got.filter("doc_id IS NULL").collect())
    assert near_dedup.near_duplicates(none).count() == 0


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 1), (9, 0, 0), (7, None, None), (None, 1, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    got = toxicity.score(docs, model, ["doc_id", "score", "text"]).collect()
    assert len(got) == 14 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not (r.text or "").strip(" \t\n")}) == 1
    assert toxicity.score(none, toxicity.fit(none, labels, F.lit(True))).count() == 0
    constant = toxicity.fit(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in toxicity.score(docs, constant).collect()} == {0.5}


def test_fingerprints(docs, none):
    got = fingerprints.edited_fingerprints(docs).collect()
    assert len(got) == 14
    by_id = {r.doc_id: r for r in got}
    assert by_id[5].lanes == by_id[6].lanes and by_id[5].near_next == 1.0
    assert set(by_id[3].lanes) == {0} and by_id[3].n_chars == 0 and by_id[3].near_edited == 1.0
    assert by_id[1].edited == "alpha beta gamma"[: 30 - 15] + ""
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprints.edited_fingerprints(none).count() == 0
    one = fingerprints.edited_fingerprints(docs.filter("doc_id = 13")).collect()
    assert len(one) == 1 and one[0].edited == "x"


def test_bpe(docs, none):
    ranks, pattern = queries.rank_file()
    ids = bpe.encode(docs, ranks, pattern, ["doc_id", "text", "ids"])
    back = bpe.decode(ids, ranks, ["text", "ids", "decoded"] if "decoded" in ids.columns else ["text", "ids"]).collect()
    assert len(back) == 14
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in back)
    assert bpe.encode(none, ranks, pattern).count() == 0


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (0, [1.0, 0.5]), (100, [0.5, -0.25]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]),
        (6, [inf, 0.0]), (7, []), (8, [1.0]), (None, [1.0, 1.0]), (9, [-1.0, 0.0]), (9, [-1.0, 0.0]), (200, [3e30, 1.0]),
    ]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("id", F.lit("old")).withColumn("v", F.lit(1))
    query = F.pmod("vec_id", F.lit(100)) == 0
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df, query, 3).collect()}
    assert got[0, 2] == (1, 1024 * 1024 + 512 * 512) and got[0, 3] == (2, 1024 * 1024 + 512 * 512)
    assert got[0, 1][0] == 200 and len([k for k in got if k[0] == 100]) == 3
    assert topk.top_k(df.limit(0), query).count() == 0
    small = topk.top_k(df.filter("vec_id IN (0, 1)"), query).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in small] == [(0, 1, 1)]


def test_licenses(docs, none):
    got = licenses.find_licenses(docs, keep=("doc_id", "text", "licenses")).collect()
    assert len(got) == 14
    for r in got:
        assert [m.license for m in r.licenses] == (["mit-statement"] if r.doc_id == 12 else [])
        for m in r.licenses:
            assert (r.text[m.start : m.end], m.coverage) == ("Released under the MIT License", 1.0)
    assert licenses.find_licenses(none).count() == 0


def test_substring_dedup(docs, none):
    got = substring_dedup.remove_repeats(docs, keep=["doc_id", "repeats", "source", "n_words"])
    assert got.columns == ["doc_id", "source", "n_words", "n_removed", "kept_text", "kept_sha256", "repeats"]
    by_id = {r.doc_id: r for r in got.filter("doc_id IS NOT NULL").collect()}
    assert got.count() == 14
    assert by_id[6].n_removed == by_id[6].n_words == 60_000 and by_id[5].n_removed == 0
    assert (by_id[8].n_words, by_id[8].n_removed, by_id[8].kept_text) == (61, 60, "tail")
    assert [(s.start, s.end) for s in by_id[8].repeats] == [(0, 60)]
    assert by_id[2].n_words == 0 and by_id[2].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert all(r.n_removed == 0 for r in got.filter("doc_id IS NULL OR doc_id = 9").collect())
    assert substring_dedup.remove_repeats(none).count() == 0


def test_many_rows_without_a_key_stay_out_of_the_joins(spark):
    passage = " ".join(f"p{k}" for k in range(30))
    rows = [(None, f"{passage} n{k}") for k in range(500)] + [(1, passage), (2, f"lead {passage}")]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), keep=["doc_id", "text"])
    for r in got.collect():
        assert (r.n_words, r.n_removed) == (31 if r.doc_id != 1 else 30, 30 if r.doc_id == 2 else 0)
        assert r.kept_text == ("lead" if r.doc_id == 2 else r.text)
    assert got.filter("doc_id IS NULL").count() == 500


def test_pipeline_stages(spark, docs, none, tmp_path):
    spark.createDataFrame([(1, 0, 1), (7, 1, 0), (12, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for table in (docs, none):
        now = table
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, str(tmp_path))
            if name != "byte_bpe":
                assert set(corpus_pipeline.COLUMNS) <= set(out.columns), name
            path = f"{tmp_path}/{table.count()}-{name}"
            out.write.parquet(path)
            now = spark.read.parquet(path)
        assert table is docs or now.count() == 0
