"""Order, samples, splits, unions, batches, combinations and audio samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.paths import encode_segment
from ..functions.wav import pcm_bytes, pcm_header, pcm_info
from ..operators import augment, batching, combine, ordering, sampling, segments
from ..operators.filters import reason_if, split_by, user_reason
from ..plans import prepare_training
from . import views as v
from .registry import check

M = v.with_views(v.MANIFEST)


def unit_sql(*parts: str) -> str:
    key = " || '|' || ".join(f"({p})::VARCHAR" for p in parts)
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def rank_sql(*parts: str) -> str:
    key = " || '|' || ".join(f"({p})::VARCHAR" for p in parts)
    return f"('0x' || substr(md5({key}), 1, 15))::BIGINT"


@check("f4_equal_groups", "SELECT o_orderkey, (ntile(7) OVER (ORDER BY o_orderkey) - 1)::INTEGER AS shard FROM orders")
def f4(spark, d):
    return sampling.equal_groups(v.table(spark, d, "orders").select("o_orderkey"), 7, "o_orderkey")


@check(
    "f5_pad_batches",
    """WITH o AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS labels FROM lineitem GROUP BY 1),
    b AS (SELECT *, (row_number() OVER (ORDER BY l_orderkey) - 1) // 16 AS batch_id FROM o),
    w AS (SELECT *, max(len(labels)) OVER (PARTITION BY batch_id) AS width FROM b)
    SELECT l_orderkey, batch_id::BIGINT AS batch_id, array_to_string(list_concat(labels, list_transform(range(0, width - len(labels)), lambda x: -100)), ' ') AS labels FROM w""",
)
def f5(spark, d):
    padded = batching.pad_batches(_labels(spark, d, False), "labels", 16, "l_orderkey", bos=7)
    return padded.select("l_orderkey", "batch_id", F.array_join(F.col("labels").cast("array<string>"), " ").alias("labels"))


def _labels(spark, d, bos):
    parts = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"])
    if bos:
        parts = F.concat(F.array(F.lit(7).cast("bigint")), parts)
    return v.table(spark, d, "lineitem").groupBy("l_orderkey").agg(parts.alias("labels"))


@check(
    "f5_t25_bos_unmask",
    """WITH o AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS labels FROM lineitem GROUP BY 1),
    b AS (SELECT *, (row_number() OVER (ORDER BY l_orderkey) - 1) // 16 AS batch_id FROM o),
    w AS (SELECT *, max(len(labels)) OVER (PARTITION BY batch_id) AS width FROM b)
    SELECT l_orderkey, batch_id::BIGINT AS batch_id, array_to_string(list_concat(labels, list_transform(range(0, width - len(labels)), lambda x: 0)), ' ') AS labels FROM w""",
)
def t25(spark, d):
    padded = batching.pad_batches(_labels(spark, d, True), "labels", 16, "l_orderkey", bos=7)
    plain = batching.unmask(F.col("labels"), 0).cast("array<string>")
    return padded.select("l_orderkey", "batch_id", F.array_join(plain, " ").alias("labels"))


@check("g2_lexical_sort", "SELECT page_id, url FROM pages ORDER BY url, page_id")
def g2(spark, d):
    return v.table(spark, d, "pages").select("page_id", "url").orderBy("url", "page_id")


@check("g3_first_n", M + "SELECT row_id, audio_filepath FROM manifest ORDER BY row_id LIMIT 20")
def g3(spark, d):
    return ordering.first_n(v.manifest(spark, d).select("row_id", "audio_filepath"))


@check("g4_head_preview", M + "SELECT row_id, audio_filepath, duration, lang, source, md5(text) AS text_md5 FROM manifest ORDER BY row_id LIMIT 5")
def g4(spark, d):
    head = ordering.first_n(v.manifest(spark, d), n=5)
    return head.select("row_id", "audio_filepath", "duration", "lang", "source", F.md5("text").alias("text_md5"))


@check("g5_review_sample", f"SELECT lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {unit_sql('doc_id', '3')}, doc_id) <= 12")
def g5(spark, d):
    return sampling.review_sample(v.table(spark, d, "documents").select("lang", "doc_id"), ["lang"], 12, "doc_id", 3)


@check(
    "g6_epoch_shuffle",
    M + f"SELECT row_id, audio_filepath, row_number() OVER (ORDER BY {rank_sql('row_id', '2', "'epoch'")}, row_id) - 1 AS place FROM manifest",
)
def g6(spark, d):
    rows = v.manifest(spark, d).select("row_id", "audio_filepath")
    return sampling.epoch_places(rows, "row_id", 2)


@check(
    "h1_with_variant",
    "SELECT vec_id, 'original' AS variant, round(list_sum(embedding::DOUBLE[]), 4) AS total FROM embeddings UNION ALL SELECT vec_id, 'augmented', round(-list_sum(embedding::DOUBLE[]), 4) FROM embeddings",
)
def h1(spark, d):
    rows = v.samples(spark, d).select("vec_id", "samples")
    both = sampling.with_variant(rows, rows.withColumn("samples", augment.invert(F.col("samples"))))
    total = F.aggregate("samples", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return both.select("vec_id", "variant", F.round(total, 4).alias("total"))


@check(
    "h2_append_rows",
    M + """SELECT audio_filepath, md5(text) AS text_md5 FROM manifest UNION ALL SELECT '/musan/' || vec_id || '.wav', md5('…') FROM embeddings""",
)
def h2(spark, d):
    noise = v.table(spark, d, "embeddings").select(F.concat(F.lit("/musan/"), "vec_id", F.lit(".wav")).alias("audio_filepath"))
    rows = sampling.append_rows(v.manifest(spark, d).select("audio_filepath", "text"), noise)
    return rows.select("audio_filepath", F.md5("text").alias("text_md5"))


SPLIT_SQL = "CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'test' ELSE 'validation' END"


@check("h3_split_sets", f"SELECT o_orderkey, {SPLIT_SQL} AS split FROM (SELECT o_orderkey, {unit_sql('o_custkey', '0')} AS u FROM orders)")
def h3(spark, d):
    return sampling.split_sets(v.table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey").select("o_orderkey", "split")


@check(
    "h3_weighted_split",
    f"""WITH g AS (SELECT o_custkey, sum(round(o_totalprice::DOUBLE * 100)::BIGINT) AS w FROM orders GROUP BY 1),
    p AS (SELECT o_custkey, w, sum(w) OVER (ORDER BY {rank_sql('o_custkey', '0', "'weight'")}, o_custkey) - w AS before, sum(w) OVER () AS total FROM g),
    m AS (SELECT o_custkey, (2 * before + w)::DOUBLE AS middle, (2 * total)::DOUBLE AS total FROM p)
    SELECT o_orderkey, CASE WHEN middle * 1000000 < total * 800000 THEN 'train' WHEN middle * 1000000 < total * 900000 THEN 'test' ELSE 'validation' END AS split,
      least(floor(middle * 7 / total), 6)::INTEGER AS shard FROM orders JOIN m USING (o_custkey)""",
)
def h3b(spark, d):
    """Customers stay whole; shares are of the price of their orders."""
    orders = v.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    split = sampling.weighted_split(orders, "o_custkey", "o_totalprice", scale=100)
    return sampling.weighted_groups(split, 7, "o_custkey", "o_totalprice", scale=100).select("o_orderkey", "split", "shard")


@check("h4_pick_share", f"SELECT event_id FROM events WHERE {unit_sql('event_id', '1')} < 0.5")
def h4(spark, d):
    return sampling.pick_share(v.table(spark, d, "events"), "event_id", 0.5, 1).select("event_id")


@check(
    "x4_join_neighbours",
    M + """, n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY row_id) - 1 AS idx FROM manifest),
    p AS (SELECT source, idx // 2 AS pair_no, max(CASE WHEN idx % 2 = 0 THEN audio_filepath END) AS first_path, max(CASE WHEN idx % 2 = 1 THEN audio_filepath END) AS second_path,
      sum(duration) AS duration, md5(string_agg(text, ' ' ORDER BY idx)) AS text_md5 FROM n GROUP BY 1, 2)
    SELECT source, pair_no::BIGINT AS pair_no, first_path, second_path, round(duration, 6) AS duration, text_md5 FROM p WHERE second_path IS NOT NULL AND duration <= 300""",
)
def x4(spark, d):
    joined = combine.join_neighbours(v.manifest(spark, d), max_s=300).kept
    return joined.select("source", "pair_no", "first_path", "second_path", F.round("duration", 6).alias("duration"), F.md5("text").alias("text_md5"))


@check(
    "x5_overtalk",
    v.with_views(v.REFS, v.TIMED_WORDS)
    + f""", f AS (SELECT audio_filepath, max("end") AS length FROM timed_words GROUP BY 1),
    k AS (SELECT *, {unit_sql('audio_filepath', '5', "'half'")} < 0.5 AS half, {rank_sql('audio_filepath', '5', "'order'")} AS o FROM f),
    r AS (SELECT *, row_number() OVER (PARTITION BY half ORDER BY o, audio_filepath) AS rk FROM k),
    m AS (SELECT a.audio_filepath AS first_path, b.audio_filepath AS second_path, a.length AS la, b.length AS lb,
      format('{{:.3f}}', {unit_sql('a.audio_filepath', 'b.audio_filepath', '5')} * least(1.5, a.length, b.length))::DOUBLE AS overlap
      FROM r a JOIN r b USING (rk) WHERE a.half AND NOT b.half),
    w AS (SELECT first_path, second_path, t.start AS s, t."end" AS e, pos, word FROM m JOIN timed_words t ON t.audio_filepath = first_path
      UNION ALL SELECT first_path, second_path, t.start + (la - overlap), t."end" + (la - overlap), pos, word FROM m JOIN timed_words t ON t.audio_filepath = second_path)
    SELECT first_path, second_path, overlap, round(la - overlap, 6) AS second_start, round(greatest(la, la - overlap + lb), 6) AS length,
      md5((SELECT string_agg(word, ' ' ORDER BY s, e, pos, word) FROM w WHERE w.first_path = m.first_path)) AS text_md5 FROM m""",
)
def x5(spark, d):
    plan = combine.overtalk(v.timed_words(spark, d), seed=5, max_overlap=1.5).kept
    return plan.select(
        "first_path", "second_path", "overlap", F.round("second_start", 6).alias("second_start"), F.round("length", 6).alias("length"), F.md5("text").alias("text_md5")
    )


@check(
    "x6_backchannels",
    v.with_views(v.REFS, v.TIMED_WORDS)
    + f""", nx AS (SELECT *, lead(start) OVER (PARTITION BY audio_filepath ORDER BY pos) - "end" AS pause,
        {unit_sql('audio_filepath', 'pos', '0', "'word'")} < 0.5 AS okay, {unit_sql('audio_filepath', 'pos', '0', "'gate'")} AS gate FROM timed_words),
    ins AS (SELECT audio_filepath, pos, CASE WHEN okay THEN 'okay' ELSE 'yes' END AS word, CASE WHEN okay THEN 0.5 ELSE 0.75 END::DOUBLE AS size, "end", pause, gate FROM nx)
    SELECT audio_filepath, pos, word, round(start, 6) AS start, round("end", 6) AS "end", false AS inserted FROM timed_words
    UNION ALL SELECT audio_filepath, pos, word, round("end" + (pause - size) / 2, 6), round("end" + (pause - size) / 2 + size, 6), true
    FROM ins WHERE pause >= size AND gate < 0.3""",
)
def x6(spark, d):
    rows = combine.insert_backchannels(v.timed_words(spark, d), [("okay", 0.5), ("yes", 0.75)], share=0.3)
    return rows.withColumns({c: F.round(c, 6) for c in ("start", "end")})


@check("t21_sample_seconds", "SELECT vec_id, round(len(embedding) / 16000.0::DOUBLE, 9) AS seconds FROM embeddings")
def t21(spark, d):
    return v.samples(spark, d).select("vec_id", F.round(F.size("samples") / F.col("sampling_rate"), 9).alias("seconds"))


NOISE_SQL = """noise AS (SELECT vec_id AS noise_id, embedding AS clip, row_number() OVER (ORDER BY vec_id) - 1 AS pick FROM embeddings WHERE label = 0)"""


def noise(spark, d):
    return v.samples(spark, d).filter("label = 0").select(F.col("vec_id").alias("noise_id"), F.col("samples").alias("noise_samples"))


@check(
    "d8_assign_noise",
    f"""WITH {NOISE_SQL} SELECT vec_id, noise_id FROM embeddings JOIN noise ON pick = floor({unit_sql("'vec_' || vec_id", '2', "'clip'")} * (SELECT count(*) FROM noise))::BIGINT""",
)
def d8(spark, d):
    return augment.assign_noise(v.samples(spark, d), noise(spark, d), "key", 2).select("vec_id", "noise_id")


def draw(what: str) -> str:
    return unit_sql("'vec_' || vec_id", "2", f"'{what}'")


@check(
    "t26_augment",
    f"""WITH {NOISE_SQL}, s AS (SELECT vec_id, embedding::DOUBLE[] AS x, clip::DOUBLE[] AS c,
        CASE WHEN {draw('gain')} < 0.1 THEN pow(10, (-2 + {draw('gain_db')} * 4) / 20) ELSE 1 END AS gain,
        CASE WHEN {draw('one_of')} < 0.5 AND {draw('background')} < 0.9 THEN 1 + {draw('snr')} END AS snr_db,
        CASE WHEN {draw('flip')} < 0.5 THEN -1.0 ELSE 1.0 END AS noise_sign,
        CASE WHEN {draw('one_of')} >= 0.5 AND {draw('gaussian')} < 0.4 THEN 0.005 + {draw('sigma')} * 0.01 END AS sigma
      FROM embeddings JOIN noise ON pick = floor({draw('clip')} * (SELECT count(*) FROM noise))::BIGINT),
    k AS (SELECT *, CASE WHEN snr_db IS NULL THEN 0 ELSE noise_sign * gain * sqrt(list_avg(list_transform(x, lambda v: v * v))) / pow(10, snr_db / 20)
        / sqrt(list_avg(list_transform(c, lambda v: v * v))) END AS f FROM s)
    SELECT vec_id, round(gain, 6) AS gain, round(snr_db, 6) AS snr_db, round(sigma, 6) AS sigma,
      CASE WHEN sigma IS NULL THEN round(list_sum(list_transform(range(1, len(x) + 1), lambda i: abs(x[i] * gain + f * c[i]))), 3) END AS loudness FROM k""",
)
def t26(spark, d):
    noisy = augment.assign_noise(v.samples(spark, d), noise(spark, d), "key", 2)
    done = augment.augment(noisy, "key", seed=2)
    loud = F.aggregate("samples", F.lit(0.0), lambda a, x: a + F.abs(x.cast("double")))
    return done.select(
        "vec_id", *[F.round(c, 6).alias(c) for c in ("gain", "snr_db", "sigma")], F.when(F.col("sigma").isNull(), F.round(loud, 3)).alias("loudness")
    )


@check(
    "t27_work_plan",
    M + """SELECT 'gsm' AS op, audio_filepath AS source, '/gsm/' || split_part(string_split(audio_filepath, '/')[-1], '.wav', 1) || '.gsm' AS target FROM manifest""",
)
def t27(spark, d):
    return segments.work_plan(v.manifest(spark, d), "gsm", "/gsm/", suffix=".gsm").select("op", "source", "target")


@check(
    "t27_trim_plan",
    v.with_views(v.SEGMENTS) + """SELECT 'trim' AS op, base || '.wav' AS source, '/out/' || base || '_0000_' || a || '_' || b || '.wav' AS target, a::DOUBLE AS seg_start, b::DOUBLE AS seg_end
    FROM (SELECT base, regexp_replace(format('{:.2f}', lo), '(\\.[0-9])0$', '\\1') AS a, regexp_replace(format('{:.2f}', hi), '(\\.[0-9])0$', '\\1') AS b FROM segments)""",
)
def t27b(spark, d):
    named = v.segments(spark, d).select(encode_segment(F.col("base"), F.col("lo"), F.col("hi")).alias("audio_filepath"))
    return segments.work_plan(named, "trim", "/out/").select("op", "source", "target", "seg_start", "seg_end")


@check(
    "u1_user_rows",
    M + "SELECT row_id, length(text)::BIGINT AS labels_length, round(duration * 2, 6) AS twice FROM manifest",
)
def u1(spark, d):
    """A row function of the user, given whole Arrow batches."""

    def prepare(batches):
        for rows in batches:
            yield rows.assign(labels_length=rows["text"].str.len(), twice=(rows["duration"] * 2).round(6))[["row_id", "labels_length", "twice"]]

    return v.manifest(spark, d).select("row_id", "text", "duration").mapInPandas(prepare, "row_id bigint, labels_length bigint, twice double")


@check("u2_user_predicate", M + "SELECT row_id FROM manifest WHERE duration > 20 AND length(text) % 2 = 0")
def u2(spark, d):
    """A predicate of the user as a filter of the library: refused rows carry its name."""
    wanted = (F.col("duration") > 20) & (F.length("text") % 2 == 0)
    return split_by(v.manifest(spark, d), reason_if(~wanted, "user")).kept.select("row_id")


@check("u2_user_function", M + "SELECT row_id, CASE WHEN length(text) % 3 <> 1 OR duration <= 5 THEN 'odd' ELSE 'kept' END AS outcome FROM manifest")
def u2_function(spark, d):
    """A vectorised function of the user, on batches of two columns."""

    def accept(text, duration):
        return (text.str.len() % 3 == 1) & (duration > 5)

    both = split_by(v.manifest(spark, d), user_reason(accept, "text", "duration", reason="odd"))
    return both.kept.select("row_id", F.lit("kept").alias("outcome")).unionByName(both.rejects.select("row_id", F.col("reason").alias("outcome")))


@check(
    "t23_cut_segments",
    """WITH c AS (SELECT vec_id, flatten(list_transform(range(8), lambda i: embedding)) AS x FROM embeddings),
    w AS (SELECT vec_id, list_transform(x, lambda v: (round(greatest(least(v, 1.0), -1.0)::DOUBLE * 32767)::BIGINT % 65536 + 65536) % 65536) AS pcm FROM c),
    s AS (SELECT vec_id, part, pcm[1 + lo:hi] AS cut FROM w, (VALUES (0, 160, 320), (1, 400, 512)) p(part, lo, hi))
    SELECT vec_id, part::INTEGER AS part, (2 * len(cut))::BIGINT AS data_bytes,
      md5(array_to_string(list_transform(cut, lambda v: printf('%02X%02X', v % 256, v // 256)), '')) AS bytes_md5 FROM s""",
)
def t23(spark, d):
    """Two pieces from inside clips of 0.032 seconds whose header has another chunk before the samples; the second piece ends with the clip."""
    data = pcm_bytes(F.flatten(F.array_repeat("embedding", 8)))
    plain = pcm_header(F.octet_length(data), F.lit(16000), F.lit(1), F.lit(16))
    note = F.unhex(F.lit("4C495354" + "04000000" + "494E464F"))
    tapes = v.table(spark, d, "embeddings").select(
        F.concat(F.lit("/waves/vec"), "vec_id", F.lit(".wav")).alias("path"),
        F.concat(F.substring(plain, 1, 36), note, F.substring(plain, 37, 8), data).alias("content"),
    )
    parts = F.array(*[F.struct(F.lit(n).alias("part"), F.lit(f"_0000_{a}_{b}.wav").alias("name")) for n, a, b in ((0, "0.01", "0.02"), (1, "0.025", "9.0"))])
    clips = v.table(spark, d, "embeddings").select("vec_id", F.inline(parts)).select(
        "vec_id", "part", F.concat(F.lit("vec"), "vec_id", "name").alias("audio_filepath")
    )
    cut = segments.cut_segments(clips, tapes).kept.withColumn("i", pcm_info(F.col("content")))
    samples = F.substring("content", 45, F.col("data_bytes").cast("int"))
    return cut.filter("i.data_bytes = data_bytes").select("vec_id", "part", "data_bytes", F.md5(F.hex(samples)).alias("bytes_md5"))


@check(
    "p3_prepare_training",
    f"""WITH parts AS (SELECT vec_id, label, len(embedding) / (1 + vec_id % 5 * 10)::DOUBLE AS seconds, {SPLIT_SQL} AS split FROM (SELECT vec_id, label, embedding, {unit_sql("'vec_' || vec_id", '0')} AS u FROM embeddings)),
    rows AS (SELECT vec_id, label, seconds, split, 'original' AS variant FROM parts UNION ALL SELECT vec_id, label, seconds, split, 'augmented' FROM parts WHERE split = 'train')
    SELECT vec_id, split, variant, CASE WHEN split = 'train' AND seconds >= 3 THEN 'long'
      WHEN split <> 'validation' AND label >= 3 THEN 'label_length' WHEN length(label::VARCHAR) < 2 AND label < 2 THEN 'blank' ELSE 'kept' END AS outcome FROM rows""",
)
def p3(spark, d):
    """Sampling rates are chosen so that clips last from 1.5 to 64 seconds, on both sides of the limit."""
    text = F.when(F.col("label") < 2, F.col("label").cast("string")).otherwise("two words")
    rate = (F.pmod("vec_id", F.lit(5)) * 10 + 1).cast("int")
    clips = v.samples(spark, d).withColumns({"text": text, "labels_length": F.col("label"), "sampling_rate": rate})
    kept, rejects = prepare_training(clips, noise(spark, d), key="key", max_labels=3, max_s=3.0)
    both = kept.withColumn("reason", F.lit("kept")).unionByName(rejects)
    return both.select("vec_id", "split", "variant", F.col("reason").alias("outcome"))
