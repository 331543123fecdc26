"""Every operator against brute force, a library, an exact round trip or held-out labels."""

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from voxloom.llm import bpe, fingerprints, licenses, mixing, near_dedup, queries, secret_scan, sharding, substring_dedup, topk, toxicity
from voxloom.llm.components import connected_components

FOLDER = "/root/testdata/sf0.001"
SF1 = "/root/testdata/sf0.01"
SF2 = "/root/testdata/sf0.1"
CHECK = "/root/testdata/check_s"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, con, name):
    got = queries.QUERIES[name](spark, FOLDER)
    want = con.execute(queries.ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    order = [names.index(c) for c in got.columns]
    assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())


@needs_tables
@pytest.mark.parametrize("name", ["op3_source_mix", "op6_fingerprints"])
def test_native_plans_hold_no_python(spark, name):
    plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- sharding


def slow_table(names, slots):
    """The table filled from whole lists of preference."""
    lists = []
    for name in names:
        start, step = sharding.preference(name, slots)
        lists.append([(start + k * step) % slots for k in range(slots)])
    owner = {}
    while len(owner) < slots:
        for k, wanted in enumerate(lists):
            free = next((s for s in wanted if s not in owner), None)
            if free is not None:
                owner[free] = k
    return [owner[s] for s in range(slots)]


def test_table_is_filled_in_turns():
    names = [f"s{k}" for k in range(7)]
    table = sharding.fill_table(names, 211)
    assert table == slow_table(names, 211)
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1


def test_weights_and_lost_shards():
    names = [f"s{k}" for k in range(20)]
    table = sharding.fill_table(names, 6553)
    fewer = sharding.fill_table(names[:-1], 6553)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 19)
    assert moved < 0.1 * 6553
    double = np.bincount(sharding.fill_table(["a", "b", "c"], 1009, {"b": 2}))
    assert abs(double[1] - 2 * double[0]) <= 3
    with pytest.raises(ValueError):
        sharding.fill_table(names, 6552)


@needs_tables
def test_placement_follows_the_table(spark):
    from hashlib import md5

    table = sharding.fill_table(queries.SHARDS)
    got = queries.shard_lookup(spark, FOLDER).collect()
    assert len(got) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for r in got:
        assert r.slot == int(md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % sharding.SLOTS and r.shard == table[r.slot]


# --- secrets


@pytest.mark.parametrize("rule", secret_scan.RULES, ids=lambda r: r.kind)
def test_matches_fulfil_the_trigram_query(rule):
    examples = {
        "assign": ["PassWord: hunter2x", 'api_key = "abcdef"', "APIKEY=zzzzzzz", "secret':'abcdefg"], "access": ["AKIA" + "A" * 16], "hex": ["0" * 24],
        "private_key": ["-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----"], "code_host": ["ghp_" + "a" * 36], "chat": ["xoxb-1234567890"],
        "signed_claims": ["eyJhbGciOiJ.eyJzdWIiOiI.c2lnbmF0dXJl"], "cloud_key": ["AIza" + "b" * 35], "payment": ["sk_live_" + "c" * 16],
    }
    query = secret_scan.trigram_query(rule.pattern)

    def holds(q, text):
        if isinstance(q, bytes):
            return q in text
        return (any if q[0] == "or" else all)(holds(p, text) for p in q[1])

    for text in examples[rule.kind]:
        assert re.search(rule.pattern, text, re.ASCII) and holds(query, text.lower().encode())
    assert rule.kind == "hex" or not holds(query, b"nothing here")


def test_scan_equals_searching_everything(spark):
    draw = random.Random(3)
    parts = ["password=", "secret: '", "AKIA", "ABCDEFGH1234567890", "0a1b2c3d", "deadbeef" * 3, " ", "token", "=", "é", "\n", "ghp_", "x" * 36, "API_KEY = "]
    texts = ["".join(draw.choices(parts, k=draw.randrange(12))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in secret_scan.find_secrets(df).collect():
        want = []
        for k, rule in enumerate(secret_scan.RULES):
            for m in re.finditer(rule.pattern, texts[r.doc_id], re.ASCII):
                if len(m.group(rule.group)) >= rule.least:
                    want.append((m.start(), k, m.end(), rule.kind))
        assert [(s.start, s.end, s.kind) for s in r.secrets] == [(a, b, kind) for a, _, b, kind in sorted(want)]


# --- mixing


def test_tree_keeps_quotas_and_shares_blocks_evenly(spark):
    quotas = {1: 1000, 2: 37, 3: 1, 4: 400}
    df = spark.createDataFrame(list(quotas.items()), "rank int, quota long")
    rows = mixing.splitting_tree(df, 3, seed=5).collect()
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, {})[r["rank"]] = r.blocks
    assert len(shards) == 8 and all(b >= 0 for s in shards.values() for b in s.values())
    assert all(sum(s[k] for s in shards.values()) == q for k, q in quotas.items())
    sizes = [sum(s.values()) for s in shards.values()]
    assert max(sizes) - min(sizes) <= 1
    for k in quotas:
        reached = 0
        for r in sorted((r for r in rows if r["rank"] == k), key=lambda r: r.shard):
            assert r.before == reached
            reached += r.blocks


def test_draws_are_hypergeometric(spark):
    white, black, drawn = 30, 20, 12
    draws = spark.range(4000).select(mixing._draw(F.lit(white).cast("bigint"), F.lit(black).cast("bigint"), F.lit(drawn).cast("bigint"), (F.col("id") + 0.5) / 4000).alias("x"))
    counts = {r.x: r["count"] for r in draws.groupBy("x").count().collect()}
    for x in range(drawn + 1):
        share = math.comb(white, x) * math.comb(black, drawn - x) / math.comb(white + black, drawn)
        assert abs(counts.get(x, 0) / 4000 - share) < 0.001


@needs_tables
def test_mix_comes_near_its_targets(spark):
    df = spark.read.parquet(f"{SF1}/documents.parquet")
    rows = mixing.mix(df, block_words=2000, depth=3).withColumn("s", F.col("source_size")).collect()
    taken, target, blocks = {}, {}, {}
    for r in rows:
        key = (r.source_size, r.target)
        target[key] = r.target
        if r.copy is not None:
            taken[key] = taken.get(key, 0) + r["size"]
            assert blocks.setdefault((key, r.block), r.shard) == r.shard
    assert all(abs(taken.get(k, 0) - t) <= 0.02 * t for k, t in target.items())


# --- near copies


def test_near_copies_equal_brute_force(spark):
    draw = random.Random(11)
    vocabulary = [f"v{k}" for k in range(3000)]
    texts = [" ".join(draw.choices(vocabulary, k=draw.randrange(1, 80))) for _ in range(60)]
    for _ in range(140):
        words = draw.choice(texts).split()
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        texts.append(" ".join(words))
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)})
    label = list(range(len(texts)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in near_dedup.near_duplicates(df).collect()}
    assert got == {k: (root(k), len(sets[k])) for k in range(len(texts))}


def test_families_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_DOCS", 4)
    draw = random.Random(2)
    base = [f"b{k}" for k in range(70)]
    texts = []
    for k in range(60):
        words = list(base)
        for at in draw.sample(range(70), 1 + k % 3):
            words[at] = f"x{k}_{at}"
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wide = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df, width=2).collect()}
    monkeypatch.setattr(near_dedup, "BLOCK_DOCS", 512)
    assert wide == {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df, width=2).collect()}


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (200, 150), (7, 7)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100, 200: 150, 150: 150}


# --- toxicity


@needs_tables
def test_held_out_toxicity(spark):
    got = queries.toxicity(spark, SF1).join(spark.read.parquet(f"{SF1}/labels.parquet"), "doc_id").filter("held_out").collect()
    good, bad = [r.score for r in got if r.toxic == 0], [r.score for r in got if r.toxic == 1]
    order = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert order > 0.7
    assert queries.toxicity(spark, SF1).count() == 1000


def slow_subwords(text):
    """Words with a blank in front and behind cut into n-grams one by one, then the words."""
    words = re.split(r"[\x20\t-\r]+", text.lower())
    words = [w for w in words if w]
    grams = [f" {w} "[a : a + n] for w in words for n in toxicity.GRAMS for a in range(len(w) + 3 - n)]
    return grams, words


def bucket_of(piece, whole):
    """The bucket of one n-gram or word, from a text that holds nothing else."""
    chars = np.array([ord(c) for c in (f" {piece} " if whole else piece)], np.uint32)
    parts = list(toxicity.subwords(chars, np.zeros(len(chars), np.int64)))
    if whole:
        return int(parts[-1][1][0])
    # Parts come by length; one n-gram of full length is the only one of its length.
    lengths = [n for n in toxicity.GRAMS if n <= len(piece)]
    return int(parts[len(lengths) - 1][1][0])


def test_scores_equal_a_slow_softmax(spark):
    draw = random.Random(11)
    letters = "abcdeXYÄß漢🙂é'"
    texts = ["", " ", None, "a", "ab cd", "\t\nA  b\r"] + [
        " ".join("".join(draw.choices(letters, k=draw.randrange(1, 12))) for _ in range(draw.randrange(1, 40))) for _ in range(194)
    ]
    rng = np.random.default_rng(2)
    # Two classes of embeddings of width 3 and a layer; the model holds the difference of the class scores.
    table, layer = rng.normal(size=(toxicity.BUCKETS, 3)), rng.normal(size=(3, 2)) * 20
    model = toxicity.Model((table @ (layer[:, 1] - layer[:, 0])).astype(np.float32), 0.3)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    for k, text in enumerate(texts):
        grams, words = slow_subwords(text or "")
        buckets = [bucket_of(g, False) for g in grams] + [bucket_of(w, True) for w in words]
        mean = sum((table[b] for b in buckets), np.zeros(3)) / (len(buckets) + toxicity.NEUTRAL)
        out = mean @ layer + np.array([0, 0.3])
        p = np.exp(out - out.max())
        assert abs(got[k] - p[1] / p.sum()) < 1e-5, text


def test_training_lowers_the_loss_of_its_softmax():
    """Bags of two kinds that differ in one bucket of ten: the folded model tells all of them apart, whatever their order."""
    rng = np.random.default_rng(6)
    labels = [k % 2 for k in range(400)]
    bags = []
    for y in labels:
        own = np.unique(np.append(rng.integers(0, 5000, 9), 6000 + y)).astype(np.int32)
        bags.append((own, np.full(len(own), 1 / (len(own) + toxicity.NEUTRAL), np.float32)))
    model = toxicity.train(toxicity.flat_bags(labels, bags), {0: 200, 1: 200})
    logits = np.array([model.weights[b] @ x for b, x in bags]) + model.bias
    assert ((logits > 0) == np.array(labels, bool)).all()
    assert model.weights[6001] > 0 > model.weights[6000]


@pytest.mark.parametrize("folder,recall", [(SF2, 0.75), (CHECK, 0.85)])
def test_held_out_recall(spark, folder, recall):
    """Floors below what was measured, 0.81 and 0.88: fewer labelled toxic documents to learn from give less recall."""
    if not os.path.exists(f"{folder}/labels.parquet"):
        pytest.skip("test tables not present")
    got = queries.toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    bad, good = [r for r in got if r.toxic == 1], [r for r in got if r.toxic == 0]
    caught, wrong = np.mean([r.predicted for r in bad]), np.mean([r.predicted for r in good])
    scores = np.sort([r.score for r in good])
    order = np.mean(np.searchsorted(scores, [r.score for r in bad])) / len(scores)
    print(f"{folder}: recall {caught:.3f} of {len(bad)}, false {wrong:.4f} of {len(good)}, order {order:.4f}")
    assert caught >= recall and wrong <= 0.02 and order >= 0.95


def test_misspelt_words_share_subwords(spark):
    draw = random.Random(4)
    calm = ["river", "stone", "cloud", "meadow", "window", "garden", "letter", "bridge"]
    texts = []
    for k in range(300):
        words = draw.choices(calm, k=20)
        if k % 2:
            words[draw.randrange(20)] = "grumbleface"
        texts.append((k, " ".join(words), k % 2))
    df = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    model = toxicity.fit(df, df.select("doc_id", "toxic"), F.lit(True))
    tests = spark.createDataFrame([(1, "river stone grumblefaces cloud meadow"), (2, "river stone cloud meadow")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(tests, model).collect()}
    assert got[1] > 0.5 > got[2]


# --- fingerprints


def test_fingerprints_add_up(spark):
    df = spark.createDataFrame([("one\ntwo\ntwo", "two\none\ntwo", "two", "one\ntwo")], "a string, b string, c string, d string")
    a, b, c, d = (fingerprints.lanes(F.col(x)) for x in "abcd")
    r = df.select(
        (a == b).alias("order"), (fingerprints.combine(d, c) == a).alias("put"), (fingerprints.combine(a, c, -1) == d).alias("out"), (a == d).alias("count"),
        fingerprints.likeness(a, b).alias("same"), fingerprints.likeness(a, c).alias("other"), F.length(fingerprints.to_text(a)).alias("n"), (F.size(a) - 8).alias("lanes"),
    ).first()
    assert (r.order, r.put, r.out, r["count"], r.same, r.n) == (True, True, True, False, 1.0, 8 * 8 + 8 * r.lanes)
    assert 0 <= r.other < 1 and 2 <= r.lanes


def test_likeness_is_near_the_jaccard_of_pieces_at_every_length(spark):
    draw = random.Random(5)

    def line(n):
        return " ".join("".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(n))

    rows, kept_shares = [], (0.0, 0.25, 0.5, 0.9, 0.99)
    for lines in (1, 10, 100, 1000, 4000):
        for kept in kept_shares:
            text = [line(200)] if lines == 1 else [line(4)[:30] for _ in range(lines)]
            if lines == 1:
                at = int(len(text[0]) * kept)
                other = [text[0][:at] + line(200)[at:]]
            else:
                at = int(lines * kept)
                other = text[:at] + [line(4)[:30] for _ in range(lines - at)]
                draw.shuffle(other)
            rows.append((lines, kept, "\n".join(text), "\n".join(other)))
    df = spark.createDataFrame(rows, "lines int, kept double, a string, b string").repartition(8)
    got = df.select(
        "lines", "kept", fingerprints.likeness(fingerprints.lanes(F.col("a")), fingerprints.lanes(F.col("b"))).alias("near"),
        fingerprints.pieces(F.col("a")).alias("pa"), fingerprints.pieces(F.col("b")).alias("pb"),
    ).collect()
    assert len(got) == len(rows)
    for r in got:
        a, b = Counter(r.pa), Counter(r.pb)
        truth = sum((a & b).values()) / sum((a | b).values())
        assert abs(r.near - truth) <= 0.1, (r.lines, r.kept, r.near, truth)
        if r.lines > 1:
            same = int(r.lines * r.kept) / r.lines
            assert truth == pytest.approx(same / (2 - same), abs=0.1)
        assert r.near > 0 or r.kept == 0


def test_a_removed_half_gives_the_lanes_of_the_rest(spark):
    draw = random.Random(6)
    lines = [" ".join(str(draw.randrange(10**6)) for _ in range(9)) + ". x, y" for _ in range(600)]
    df = spark.createDataFrame([("\n".join(lines), "\n".join(lines[:300]), "\n".join(lines[300:]))], "a string, b string, c string")
    a, b, c = (fingerprints.lanes(F.col(x)) for x in "abc")
    assert df.select((fingerprints.combine(a, b, -1) == c) & (fingerprints.combine(b, c) == a)).first()[0]


# --- byte-level BPE


@needs_tables
def test_ids_equal_the_library(spark):
    import base64

    import tiktoken

    path, pattern = queries.rank_file()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = ["a" * 3000, "ab" * 700, "  \n\t x", "naïve 漢字漢字 🙂🙂", "x" * 97 + " y", "don't DON'T"]
    extra = spark.createDataFrame([(10_000 + k, t) for k, t in enumerate(extra)], "doc_id long, text string")
    both = df.select("doc_id", "text").unionByName(extra)
    texts = {r.doc_id: r.text for r in both.collect()}
    ids = bpe.encode(both, path, pattern)
    assert all(r.ids == library.encode_ordinary(texts[r.doc_id]) for r in ids.collect())
    assert all(bytes(r.decoded) == texts[r.doc_id].encode() for r in bpe.decode(ids, path).collect())


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="abé🙂 ", min_size=1, max_size=120))
def test_both_merge_loops_agree(text):
    ranks = bpe.read_ranks(open(queries.rank_file()[0], "rb").read())
    piece = text.encode()
    if piece not in ranks:
        assert bpe._merge_long(piece, ranks) == bpe.merge_piece(piece[:bpe._LONG_PIECE], ranks) or len(piece) > bpe._LONG_PIECE
    assert b"".join({r: p for p, r in ranks.items()}[k] for k in bpe.merge_piece(piece, ranks)) == piece


# --- top-k


@settings(max_examples=20, deadline=None)
@given(st.integers(1, 60), st.integers(1, 6), st.integers(0, 10**6))
def test_block_search_is_exact(n, width, seed):
    draw = np.random.default_rng(seed)
    vectors = draw.integers(-3, 4, (n, width))
    ids = draw.permutation(n)
    got = topk.search_block(vectors[:5], ids[:5], vectors, ids, 4)
    want = []
    for q, qid in zip(vectors[:5], ids[:5]):
        scored = sorted((-int(v @ q), int(i)) for v, i in zip(vectors, ids) if i != qid)[:4]
        want += [(int(qid), i, -s) for s, i in scored]
    assert sorted(got) == sorted(want)


def test_blocks_and_batches_merge(spark):
    draw = np.random.default_rng(1)
    rows = [(int(k), [float(x) for x in draw.normal(size=8)]) for k in range(1200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    few = topk.top_k(df, F.pmod("vec_id", F.lit(100)) == 0, block_rows=100, batch_rows=5)
    one = topk.top_k(df, F.pmod("vec_id", F.lit(100)) == 0)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, one.collect()))


@needs_tables
def test_the_mix_reaches_the_shards_by_the_tree(spark):
    """Every copy has a shard; a shard holds only blocks of its quota, and quotas of a source add up to its blocks."""
    mixed = mixing.mix(spark.read.parquet(f"{FOLDER}/documents.parquet"), block_words=256, depth=3).collect()
    copies = [r for r in mixed if r.copy is not None]
    assert copies and all(r.shard is not None and 0 <= r.shard < 8 for r in copies)
    home = {}
    for r in copies:
        assert home.setdefault((r.source_size, r.target, r.block), r.shard) == r.shard
    blocks = [sum(1 for s in home.values() if s == k) for k in range(8)]
    # Shards have equally many blocks; some blocks hold no beginning of a document and do not show.
    assert max(blocks) - min(blocks) <= len(home) // 8
    quotas = spark.createDataFrame([(1, 37), (2, 5), (3, 400)], "rank int, quota long")
    leaves = mixing.splitting_tree(quotas, 3).collect()
    assert {k: sum(r.blocks for r in leaves if r.rank == k) for k in (1, 2, 3)} == {1: 37, 2: 5, 3: 400}
    sizes = [sum(r.blocks for r in leaves if r.shard == k) for k in range(8)]
    assert max(sizes) - min(sizes) <= 1


# --- licenses


def slow_align(template, words):
    """Words matched by the best local alignment over the whole table."""
    best = (0, 0)
    before = [(0, 0)] * (len(words) + 1)
    for a in template:
        now = [(0, 0)]
        for j, b in enumerate(words):
            s, n = before[j]
            cells = [(s + 2, n + 1) if a == b else (s - 1, n), (before[j + 1][0] - 1, before[j + 1][1]), (now[j][0] - 1, now[j][1])]
            cell = max(cells, key=lambda c: c[0])
            now.append(cell if cell[0] > 0 else (0, 0))
            best = max(best, now[-1])
        before = now
    return best


def test_banded_alignment_equals_the_whole_table():
    draw = random.Random(9)
    for _ in range(60):
        template = [draw.randrange(1000) for _ in range(40)]
        copy = list(template)
        for _ in range(draw.randrange(4)):
            at = draw.randrange(1, len(copy) - 1)
            copy[at : at + draw.randrange(2)] = [draw.randrange(1000, 2000) for _ in range(draw.randrange(2))]
        lead = [draw.randrange(2000, 3000) for _ in range(draw.randrange(20))]
        words = lead + copy + [draw.randrange(3000, 4000) for _ in range(10)]
        hit, a, b = licenses.align(template, words, len(lead))
        assert hit == slow_align(template, words)[1]
        assert a >= len(lead) and b <= len(lead) + len(copy)


def test_license_scan_equals_brute_force(spark):
    draw = random.Random(5)
    names = list(licenses.TEMPLATES)
    texts, want = [], []
    for k in range(40):
        name = names[k % len(names)]
        words = licenses.TEMPLATES[name].split()
        if k >= 20 and len(words) > 20:
            words[draw.randrange(len(words))] = "changed"
        noise = [f"n{draw.randrange(10**6)}" for _ in range(draw.randrange(30))]
        texts.append((k, " ".join([*noise, *words, *noise])))
        want.append(name)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: [m.license for m in r.licenses] for r in licenses.find_licenses(df).collect()}
    for k, name in enumerate(want):
        # The statement of a license may stand inside its longer notice.
        assert name in got[k] and set(got[k]) <= {name, "apache-2.0-statement"}


ALL_TEMPLATES = {**licenses.TEMPLATES, **licenses.WHOLE_TEXTS}


@pytest.mark.parametrize("places", [1, 2])
def test_licenses_with_inserted_words_are_found_whole(spark, places):
    """Five to 200 foreign words at one or two places: coverage is 1 and the span runs from the first to the last word."""
    draw = random.Random(places)
    rows, want = [], {}
    for name, template in ALL_TEMPLATES.items():
        words = template.split()
        if len(words) < 25:
            continue
        for extra in (5, 8, 9, 12, 20, 60, 200):
            cuts = sorted(draw.sample(range(6, len(words) - 6, 6), places))
            parts = [words[a:b] for a, b in zip([0, *cuts], [*cuts, len(words)])]
            fill = [" ".join(f"x{draw.randrange(10**6)}" for _ in range(extra)) for _ in cuts]
            body = " ".join(parts[0]) + "".join(f" {f} {' '.join(p)}" for f, p in zip(fill, parts[1:]))
            rows.append((len(rows), f"lead words {body} tail words"))
            want[len(rows) - 1] = (name, body)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in licenses.find_licenses(df, ALL_TEMPLATES, keep=("doc_id", "text")).collect():
        name, body = want[r.doc_id]
        mine = [m for m in r.licenses if m.license == name]
        assert [m.coverage for m in mine] == [1.0], (name, mine)
        assert r.text[mine[0].start : mine[0].end].strip(".") == body.strip("."), name


def slow_chain(runs, gap):
    """Most words of one chain, every order of runs tried."""
    best = 0

    def grow(total, last, rest):
        nonlocal best
        best = max(best, total)
        for k, (i, j, n) in enumerate(rest):
            if last is not None:
                x, y = last[0] + last[2], last[1] + last[2]
                tail = [(i + s, j + s) for s in range(n) if i + s >= x and j + s >= y]
                if not tail or tail[0][1] - y > gap:
                    continue
                far = max(tail[0][0] - x, tail[0][1] - y) > licenses.BAND
                if far and min(len(tail), last[2]) < licenses.GRAM:
                    continue
                grow(total + len(tail), (i, j, n), rest[:k] + rest[k + 1 :])
            else:
                grow(total + n, (i, j, n), rest[:k] + rest[k + 1 :])

    grow(0, None, runs)
    return best


def test_chains_equal_trying_every_order():
    draw = random.Random(3)
    for _ in range(300):
        runs = [(draw.randrange(40), draw.randrange(80), draw.randrange(1, 20)) for _ in range(draw.randrange(1, 6))]
        got = licenses.chain(runs, 1, 15)
        assert max(hits for hits, _, _ in got) == slow_chain(runs, 15)
        ordered = sorted((a, b) for _, a, b in got)
        assert all(b <= c for (_, b), (c, _) in zip(ordered, ordered[1:]))


def test_a_license_repeated_many_times_is_found_each_time(spark):
    words = licenses.TEMPLATES["mit"].split()
    split = " ".join(words[:40]) + " footer" * 15 + " " + " ".join(words[40:])
    df = spark.createDataFrame([(1, " ".join([split] * 300))], "doc_id long, text string")
    found = licenses.find_licenses(df).first().licenses
    assert [(m.license, m.coverage) for m in found] == [("mit", 1.0)] * 300
    assert len({m.end - m.start for m in found}) == 1


@needs_tables
def test_license_statements_in_the_tables(spark):
    got = {r.doc_id: r.n_matches for r in queries.license_scan(spark, FOLDER).collect()}
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        assert bool(got[r.doc_id]) == bool(re.search("Released under the MIT License|Licensed under the Apache License, V|GNU General Public License, version 3|under CC BY-NC 4.0", r.text)), r.doc_id


# --- repeats


def slow_repeats(rows, window):
    words = {k: t.split() for k, t in rows}
    low = {}
    for k, w in words.items():
        for i in range(len(w) - window + 1):
            x = tuple(w[i : i + window])
            low[x] = min(low.get(x, k), k)
    out = {}
    for k, w in words.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if low[tuple(w[i : i + window])] < k:
                gone |= set(range(i, i + window))
        out[k] = " ".join(x for i, x in enumerate(w) if i not in gone)
    return out


@pytest.mark.parametrize("window", [3, 5, 13])
def test_repeats_equal_brute_force(spark, monkeypatch, window):
    monkeypatch.setattr(substring_dedup, "_FLUSH", 50)
    draw = random.Random(window)
    passages = [[f"p{draw.randrange(40)}" for _ in range(draw.randrange(5, 40))] for _ in range(6)]
    rows = []
    for k in range(80):
        words = []
        for _ in range(draw.randrange(5)):
            words += draw.choice(passages) if draw.random() < 0.5 else [f"u{draw.randrange(10**6)}" for _ in range(draw.randrange(20))]
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.kept_text for r in substring_dedup.remove_repeats(df, window).collect()}
    assert got == slow_repeats(rows, window)


# --- pipeline


@needs_tables
def test_pipeline_against_its_stages(spark):
    """Stage by stage against brute force on the smallest tables."""
    import tiktoken, base64

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    calm = corpus_pipeline.drop_toxic(spark, docs, FOLDER)
    model = toxicity.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"), ~queries.held_out(F.col("doc_id")))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    texts = {r.doc_id: r.text for r in calm.collect()}
    assert set(texts) == {k for k, s in scores.items() if s < 0.5}
    one = corpus_pipeline.one_of_each(spark, calm, FOLDER)
    sets = {}
    for k, t in texts.items():
        w = re.sub("[A-Z]", lambda m: m.group().lower(), t).split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}
    near = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    kept = {r.doc_id for r in one.collect()}
    assert not any(a in kept and b in kept for a, b in near)
    assert set(texts) - kept <= {b for _, b in near}
    clean = corpus_pipeline.hide_secrets(spark, one, FOLDER)
    for r in clean.collect():
        want = texts[r.doc_id]
        spans = sorted((m.start(), m.end()) for rule in secret_scan.RULES for m in re.finditer(rule.pattern, want, re.ASCII) if len(m.group(rule.group)) >= rule.least)
        pieces, reached = [], 0
        for a, b in spans:
            if a >= reached:
                pieces += [want[reached:a], "[secret]"]
            reached = max(reached, b)
        assert r.text == "".join(pieces) + want[reached:] and r.n_chars == len(r.text)
    mixed = corpus_pipeline.mix_sources(spark, clean, FOLDER)
    plan = {}
    for r in mixing.mix(clean).filter("copy IS NOT NULL").collect():
        plan[r.doc_id] = plan.get(r.doc_id, 0) + 1
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == plan
    path, pattern = queries.rank_file()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    final = {r.doc_id: r for r in corpus_pipeline.tokenize(spark, mixed, FOLDER).collect()}
    assert all(final[r.doc_id].ids == library.encode_ordinary(r.text) and final[r.doc_id].exact for r in mixed.collect())
    assert corpus_pipeline.run(spark, FOLDER).count() == sum(plan.values())


def test_folded_merges_agree(spark):
    words = ["hello", " worlds", "é漢字", "", "a" * 9, None, "qzxv", "Licensed"]
    path = queries.rank_file()[0]
    ranks = bpe.read_ranks(open(path, "rb").read())
    got = {r.word: r.ids for r in bpe.merge_words(spark.createDataFrame([(w,) for w in words], "word string"), path).collect()}
    assert got == {w: None if w is None else bpe.merge_piece(w.encode(), ranks) for w in words}
