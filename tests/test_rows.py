"""Filters, duplicates, listings, keywords, loan words, order, sets and batches."""

import random

from pyspark.sql import functions as F

from tests.conftest import rows
from voxloom.operators import batching, counting, dedupe, durations, existence, fallback, filters, keywords, loanwords, ordering, sampling
from voxloom.plans import clean_manifest


def reasons(split, key):
    return rows(split.kept, key), rows(split.rejects, key, "reason")


def test_bands(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (30.0,), (30.01,), (None,)], "duration double")
    kept, bad = reasons(filters.duration_band(df, "duration", 1, 30), "duration")
    assert kept == [(1.0,), (30.0,)] and bad == [(0.5, "short"), (30.01, "long"), (None, "no_duration")]
    lengths = spark.createDataFrame([("train", 0.0), ("train", 0.1), ("train", 30.0), ("test", 30.0)], "split string, n double")
    assert rows(filters.duration_band(lengths, "n", 0, 30, inclusive=False, split="train").kept) == [("test", 30.0), ("train", 0.1)]


def test_text_filters(spark):
    df = spark.createDataFrame([("a:b",), ("你好",), ("don't",), ("don’t",), ("x-y",), (None,), (" ",), ("[UNK] z",)], "text string")
    assert {r.text for r in filters.drop_special_chars(df).kept.collect()} == {" ", "don't", "x-y", "你好"}
    assert (None,) not in rows(filters.drop_blank(df).kept) and (" ",) not in rows(filters.drop_blank(df).kept)
    assert ("[UNK] z",) in rows(filters.drop_marker(df).rejects, "text")
    both = filters.drop_marker(df)
    assert both.kept.count() + both.rejects.count() == df.count()
    labels = spark.createDataFrame([("train", 399), ("train", 400), ("validation", 999)], "split string, n int")
    assert rows(filters.below_length(labels, "n").kept) == [("train", 399), ("validation", 999)]
    refs = spark.createDataFrame([("a",), ("ab",), (None,)], "ref string")
    assert rows(filters.split_empty_refs(refs).kept) == [("ab",)]
    rates = spark.createDataFrame([(0.49,), (0.5,), (None,)], "wer double")
    assert rows(filters.below_rate(rates, "wer").kept) == [(0.49,)]


def test_clean_manifest(spark):
    df = spark.createDataFrame(
        [("a.wav", 2.0, "ok"), ("b.wav", 0.2, "ok"), ("c.mp3", 2.0, "ok"), ("d.wav", 2.0, "[UNK]"), ("e.wav", 2.0, "  "), ("f.wav", 2.0, "#")],
        "audio_filepath string, duration double, text string",
    )
    kept, bad = reasons(clean_manifest(df), "audio_filepath")
    assert kept == [("a.wav",)]
    assert bad == [("b.wav", "short"), ("c.mp3", "extension"), ("d.wav", "marker"), ("e.wav", "blank"), ("f.wav", "special_character")]


def test_durations_and_duplicates(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 0.5), ("c", 31.0)], "audio_filepath string, duration double")
    assert rows(durations.duration_report(df)) == [(31.5, 0.01, 1, 1, 2)]
    assert rows(durations.duration_issues(df), "audio_filepath", "issue") == [("a", "empty"), ("a", "short"), ("b", "short"), ("c", "long")]
    copies = spark.createDataFrame([("/p/a", "t"), ("/p/a", "t"), ("/q/a", "u"), (None, None)], "audio_filepath string, text string")
    assert rows(dedupe.duplicate_rows(copies)) == [(1,)]
    assert rows(dedupe.duplicate_names(copies.filter("text IS NOT NULL"))) == [(2, 1)]
    tricky = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "-"), ("-", None)], "x string, y string")
    assert rows(dedupe.duplicate_rows(tricky)) == [(0,)]
    first = spark.createDataFrame([(1, "a.wav", "x"), (2, "a.wav", "y")], "row_id int, k string, t string")
    assert rows(dedupe.first_by(first, "k")) == [(1, "a.wav", "x")]


def test_rename_plan(spark):
    df = spark.createDataFrame([("/yt/One [x1].wav",), ("/yt/Two [x1].wav",), ("/yt/T [y].wav",), ("/yt/plain.wav",)], "path string")
    assert rows(dedupe.rename_plan(df)) == [
        ("/yt/One [x1].wav", "/yt/x1.wav", True), ("/yt/T [y].wav", "/yt/y.wav", False), ("/yt/Two [x1].wav", "/yt/x1.wav", True)
    ]


def test_existence(spark):
    manifest = spark.createDataFrame([("/a.wav",), ("/a.wav",), ("/b.wav",)], "audio_filepath string")
    listing = spark.createDataFrame([("file:///a.wav",), ("file:/a.wav",), ("/z.wav",)], "path string")
    split = existence.check_exists(manifest, listing)
    assert rows(split.kept) == [("/a.wav",)] * 2 and rows(split.rejects, "audio_filepath") == [("/b.wav",)]
    assert rows(existence.exist_counts(manifest, listing)) == [(2, 1)]


def keyword_loop(texts, words, cap):
    used, out = set(), []
    for word in words:
        count = 0
        for at, text in enumerate(texts):
            if word in text:
                count += 1
                if text not in used:
                    used.add(text)
                    out.append((at, word))
            if count == cap:
                break
    return sorted(out, key=repr)


def test_keyword_selection(spark):
    texts = ["ab", "ab", "xab", "b", "bb"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id int, text string")
    assert rows(keywords.select_by_keywords(df, ["ab", "b"], cap=2), "row_id", "keyword") == [(0, "ab")]
    assert rows(keywords.keyword_counts(df, ["ab", "b", "q"], cap=2), "keyword", "n", "small") == [("ab", 2, True), ("b", 2, True), ("q", 0, True)]
    random.seed(1)
    texts = ["".join(random.choices("abc", k=4)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id int, text string").repartition(7)
    for cap in (3, 20, 10**6):
        got = rows(keywords.select_by_keywords(df, ["ab", "bc", "a", "ccc"], cap=cap), "row_id", "keyword")
        assert got == keyword_loop(texts, ["ab", "bc", "a", "ccc"], cap)


def test_long_keyword_lists_agree(spark):
    random.seed(4)
    words = ["".join(random.choices("abcé", k=random.randint(1, 4))) for _ in range(150)]
    df = spark.createDataFrame([("".join(random.choices("abcé", k=30)),) for _ in range(40)] + [(None,)], "text string")
    want = sorted(((t, at) for (t,) in rows(df) if t for at, w in enumerate(words) if w in t), key=repr)
    assert rows(keywords.keyword_matches(df, words), "text", "kw_ord") == want


def loan_loop(truth, heard):
    left, tp, fp, fn = list(heard), 0, 0, 0
    for w in heard:
        tp, fp = (tp + 1, fp) if w in truth else (tp, fp + 1)
    for w in truth:
        if w in left:
            left.remove(w)
        else:
            fn += 1
    return tp, fp, fn


def test_loan_words(spark):
    random.seed(6)
    cases = {"c1": "usd fx usd usd".split(), "c2": [], "c3": random.choices(["usd", "spot", "q", "fx"], k=40)}
    truth = ["usd", "usd", "spot"]
    t = spark.createDataFrame([(truth,), (["好"],)], "ref_words array<string>")
    h = spark.createDataFrame([(c, w) for c, w in cases.items()] + [("c1", ["好"])], "checkpoint string, hyp_words array<string>")
    got = loanwords.loan_word_scores(loanwords.loan_words(t), loanwords.loan_words(h, "hyp_words", ["checkpoint"]))
    assert rows(got) == [(c, *loan_loop(truth, w)) for c, w in sorted(cases.items())]
    only = loanwords.loan_word_scores(loanwords.loan_words(t), loanwords.loan_words(h, "hyp_words", ["checkpoint"]), only=["spot"])
    assert rows(only)[0] == ("c1", 0, 0, 1)


def test_language_fallback(spark):
    tracks = spark.createDataFrame([("v1", "zh-HK"), ("v1", "zh"), ("v2", "en"), ("v3", "zh-TW"), ("v3", "zh-Hant")], "id string, lang string")
    assert rows(fallback.first_language(tracks)) == [("v1", "zh"), ("v3", "zh-Hant")]
    parts = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "id string, n int")
    assert rows(fallback.tracks_with_segments(parts)) == [("a", 1), ("a", 2)]


def test_dense_index_with_hot_group_and_wide_ids(spark):
    random.seed(8)
    ids = [random.randrange(-(2**62), 2**62) for _ in range(300)] + list(range(700))
    data = [(i, "hot" if random.random() < 0.5 else f"g{i % 5}") for i in ids]
    df = spark.createDataFrame(data, "row_id bigint, g string").repartition(6)
    want = {i: n for n, i in enumerate(sorted(ids))}
    for bits in (3, 16):
        assert {r.row_id: r.idx for r in ordering.dense_index(df, row_bits=bits).collect()} == want
    by_group = {}
    for i, g in sorted(data):
        by_group.setdefault(g, []).append(i)
    got = {(r.g, r.row_id): r.idx for r in ordering.dense_index(df, group=["g"], row_bits=4).collect()}
    assert got == {(g, i): n for g, members in by_group.items() for n, i in enumerate(members)}


def test_top_per_group_and_skew_join(spark):
    df = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(500)], "k string, n int").repartition(5)
    got = rows(ordering.top_per_group(df, ["k"], ["n"], 4, salts=3).filter("k = 'hot'"))
    assert got == [("hot", n) for n in (1, 2, 4, 5)]
    look = spark.createDataFrame([("hot", "H"), ("k0", "Z")], "k string, v string")
    import voxloom.operators.ordering as o

    plain = rows(df.join(look, "k"), "k", "n", "v")
    assert rows(o.skew_join(df, look, ["k"]), "k", "n", "v") == plain
    assert rows(o.skew_join(df, look, ["k"], least=10), "k", "n", "v") == plain
    assert rows(o.skew_join(df, look, ["k"], how="left", least=10), "k", "n", "v") == rows(df.join(look, "k", "left"), "k", "n", "v")


def test_batches(spark):
    df = spark.createDataFrame([(7, [5, 1]), (9, [5, 2, 3]), (20, [4]), (30, [])], "row_id int, labels array<int>")
    got = [r.labels for r in batching.pad_batches(df, "labels", 2, bos=5).orderBy("row_id").collect()]
    assert got == [[1, -100], [2, 3], [4], [-100]]
    plain = spark.createDataFrame([([1, -100],)], "x array<int>")
    assert plain.select(batching.unmask(F.col("x"), 0)).first()[0] == [1, 0]


def test_sets(spark):
    df = spark.range(5000).select(F.col("id").alias("row_id"), (F.col("id") % 700).alias("speaker"))
    parts = sampling.split_sets(df, "speaker")
    assert parts.count() == 5000
    assert parts.groupBy("speaker").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    share = {r["split"]: r["count"] / 5000 for r in parts.groupBy("split").count().collect()}
    assert abs(share["train"] - 0.8) < 0.06 and set(share) == {"train", "test", "validation"}
    assert rows(parts) == rows(sampling.split_sets(df.repartition(9), "speaker"))
    half = sampling.pick_share(df, "row_id")
    assert 2300 < half.count() < 2700
    sizes = [r["count"] for r in sampling.equal_groups(df, 7).groupBy("shard").count().orderBy("shard").collect()]
    assert sizes == [715, 715, 714, 714, 714, 714, 714]
    one, two = (rows(sampling.epoch_shuffle(df, "row_id", e)) for e in (1, 2))
    assert one == two and sampling.epoch_shuffle(df, "row_id", 1).first() != sampling.epoch_shuffle(df, "row_id", 2).first()
    extra = sampling.append_rows(spark.createDataFrame([("a", "t")], "p string, text string"), spark.createDataFrame([("n",)], "p string"))
    assert rows(extra) == [("a", "t"), ("n", "…")]


def test_counts_while_flowing(spark):
    df = spark.range(10)
    seen_df, seen = counting.observed(df.filter("id > 3"))
    seen_df.write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 6
    assert rows(counting.stage_counts(df, [("a", F.col("id") > 3), ("b", F.col("id") > 7)]), "position", "n") == [(0, 10), (1, 6), (2, 2)]


def test_no_row_is_lost_to_nulls(spark):
    df = spark.createDataFrame([(None, "g"), (5, None), (7, None), (1, "g"), (None, None)], "row_id bigint, g string")
    got = rows(ordering.dense_index(df, group=["g"]), "g", "row_id", "idx")
    assert sorted(got, key=repr) == sorted([("g", None, 0), ("g", 1, 1), (None, None, 0), (None, 5, 1), (None, 7, 2)], key=repr)
    look = spark.createDataFrame([(None, "N"), ("g", "G")], "g string, v string")
    assert ordering.skew_join(df, look, ["g"]).count() == 5
    assert fallback.tracks_with_segments(df.withColumnRenamed("g", "id")).count() == 5


def test_long_digit_runs(spark):
    names = ["a" + "9" * 21 + d for d in "312"] + ["a" + "0" * 30 + "7", "a10"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    from voxloom.functions.paths import natural_key

    assert [r.n for r in df.orderBy(natural_key(F.col("n"))).collect()] == [names[3], names[4], names[1], names[2], names[0]]


def test_keyword_lists_of_any_length_agree(spark):
    df = spark.createDataFrame([("abc",), ("",), (None,)], "text string")
    words = ["", "b", "zz"]
    short = [r[0] for r in df.select(keywords.keyword_hits(F.col("text"), words)).collect()]
    long = [r[0] for r in df.select(keywords.keyword_hits(F.col("text"), words + ["#"] * 70)).collect()]
    assert short == long == [[0, 1], [0], []]


def test_noise_table_without_rows(spark):
    from voxloom.operators.augment import assign_noise, augment

    base = spark.createDataFrame([("a", [0.5, -0.5])], "key string, samples array<float>")
    noise = spark.createDataFrame([], "noise_id bigint, noise_samples array<float>")
    noisy = assign_noise(base, noise, "key")
    assert rows(noisy, "key", "noise_id") == [("a", None)] and augment(noisy, "key").count() == 1


def test_character_references(spark):
    from voxloom.functions.text import strip_tags

    df = spark.createDataFrame([("<p>it&#39;s caf&eacute;&nbsp;&amp; more</p>",), ("a &lt;b&gt; &amp;c",)], "html string")
    assert [r[0] for r in df.select(strip_tags(F.col("html"))).collect()] == ["it's café & more", "a <b> &c"]


def test_keyword_tables_of_several_parts(spark):
    df = spark.createDataFrame([(1, "abcd"), (2, "bc x"), (3, None)], "row_id int, text string")
    table = spark.createDataFrame([(w,) for w in ["bc", "d", "x", "q", "bc", None, ""]], "keyword string")
    want = [(1, ""), (1, "bc"), (1, "d"), (2, ""), (2, "bc"), (2, "x")]
    for per in (1, 100):
        assert rows(keywords.keyword_table_matches(df, table, per=per), "row_id", "keyword") == want


def test_a_function_of_the_user_judges_batches(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "abc"), (3, None), (4, "")], "row_id int, text string")
    both = filters.split_by(df, filters.user_reason(lambda t: t.str.len().map({2: True, 3: False}), "text", reason="mine"))
    assert [r.row_id for r in both.kept.collect()] == [1]
    assert sorted((r.row_id, r.reason) for r in both.rejects.collect()) == [(2, "mine"), (3, "mine"), (4, "mine")]
