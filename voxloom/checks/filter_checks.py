"""Projections, filters, joins with listings, aggregates over manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import has_extension, name_parts_ne, route_paths
from ..functions.text import SPECIAL_CHARACTERS, char_class
from ..operators import counting, dedupe, durations, existence, fallback, filters
from ..plans import manifest_reason
from ..streaming import first_arrivals, start_batches
from . import views as v
from .registry import check

M = v.with_views(v.MANIFEST)
ML = v.with_views(v.MANIFEST, v.LISTING)


def outcome(split, *cols):
    both = split.kept.withColumn("reason", F.lit("kept")).unionByName(split.rejects)
    return both.select(*cols, F.col("reason").alias("outcome"))


def judged(df, reason, *cols):
    """The same in one pass, from the reason column itself."""
    return df.select(*cols, F.coalesce(reason, F.lit("kept")).alias("outcome"))


def band_sql(lo, hi, source="manifest", key="row_id", col="duration"):
    return f"SELECT {key}, CASE WHEN {col} > {hi} THEN 'long' WHEN {col} < {lo} THEN 'short' ELSE 'kept' END AS outcome FROM {source}"


@check("c1a_duration_band", "SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_quantity > 30 THEN 'long' WHEN l_quantity < 1 THEN 'short' ELSE 'kept' END AS outcome FROM lineitem")
def c1a(spark, d):
    return outcome(filters.duration_band(v.table(spark, d, "lineitem"), "l_quantity", 1, 30), "l_orderkey", "l_linenumber", "l_quantity")


@check("c1b_short_band", M + band_sql(0.3, 30))
def c1b(spark, d):
    return outcome(filters.duration_band(v.manifest(spark, d), "duration", 0.3, 30), "row_id")


@check(
    "c1c_train_length",
    M + """SELECT row_id, CASE WHEN lang = 'en' AND duration >= 30 THEN 'long' WHEN lang = 'en' AND duration <= 0 THEN 'short' ELSE 'kept' END AS outcome FROM manifest""",
)
def c1c(spark, d):
    rows = v.manifest(spark, d).withColumn("split", F.when(F.col("lang") == "en", "train").otherwise("test"))
    return outcome(filters.duration_band(rows, "duration", 0, 30, inclusive=False, split="train"), "row_id")


@check("c2_marker", M + "SELECT row_id, CASE WHEN contains(text, 'tion') THEN 'marker' ELSE 'kept' END AS outcome FROM manifest")
def c2(spark, d):
    return outcome(filters.drop_marker(v.manifest(spark, d), marker="tion"), "row_id")


SPECIAL = char_class(SPECIAL_CHARACTERS).replace("'", "''")


@check("c3_special_characters", M + f"SELECT row_id, CASE WHEN regexp_matches(text, '{SPECIAL}') THEN 'special_character' ELSE 'kept' END AS outcome FROM manifest")
def c3(spark, d):
    return judged(v.manifest(spark, d), filters.special_reason(F.col("text")), "row_id")


@check("c4_blank_text", M + "SELECT row_id, CASE WHEN length(replace(text, ' ', '')) < 40 THEN 'blank' ELSE 'kept' END AS outcome FROM manifest")
def c4(spark, d):
    return outcome(filters.drop_blank(v.manifest(spark, d), min_len=40), "row_id")


@check("c5_extension", "SELECT page_id, (string_split(url, '.')[-1] = 'html') AS is_html FROM pages")
def c5(spark, d):
    return v.table(spark, d, "pages").select("page_id", has_extension(F.col("url"), ".html").alias("is_html"))


@check("c6_name_parts", "SELECT page_id FROM pages WHERE len(string_split(string_split(replace(url, '?', '_'), '/')[-1], '_')) <> 2")
def c6(spark, d):
    name = F.replace("url", F.lit("?"), F.lit("_"))
    return v.table(spark, d, "pages").filter(name_parts_ne(name, 2)).select("page_id")


@check("c8_label_length", "SELECT o_orderkey, CASE WHEN l.lang <> 'validation' AND n >= 4 THEN 'label_length' ELSE 'kept' END AS outcome FROM (SELECT l_orderkey AS o_orderkey, count(*) AS n, CASE WHEN max(l_returnflag) = 'A' THEN 'train' WHEN max(l_returnflag) = 'N' THEN 'test' ELSE 'validation' END AS lang FROM lineitem GROUP BY 1) l")
def c8(spark, d):
    # The greatest flag by a number: a buffer of strings would have Spark sort the table, each task holding its rows.
    flag = F.col("l_returnflag")
    rank = F.max(F.when(flag > "N", 4).when(flag == "N", 3).when(flag > "A", 2).when(flag == "A", 1).otherwise(0))
    split = F.when(rank == 1, "train").when(rank == 3, "test").otherwise("validation").alias("split")
    rows = v.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("labels_length"), split)
    return outcome(filters.below_length(rows, "labels_length", 4), "o_orderkey")


@check("c11_projection", M + "SELECT audio_filepath, format('{:.2f}', duration)::DOUBLE AS duration, md5(text) AS text FROM manifest")
def c11(spark, d):
    from ..sources.manifest import rounded_manifest

    rows = v.manifest(spark, d).withColumns({"seconds": F.col("duration"), "text": F.md5("text")}).drop("duration")
    return rounded_manifest(filters.to_manifest(rows, duration="seconds"))


@check(
    "c12_route_paths",
    M + """SELECT row_id, CASE WHEN contains(audio_filepath, 'src1/') THEN '/home/wavs/' || string_split(audio_filepath, '/')[-1]
      WHEN contains(audio_filepath, 'src1') THEN '/home/all_wavs/' || string_split(audio_filepath, '/')[-1] ELSE audio_filepath END AS target FROM manifest""",
)
def c12(spark, d):
    rules = [("src1/", "/home/wavs/"), ("src1", "/home/all_wavs/")]
    return v.manifest(spark, d).select("row_id", route_paths(F.col("audio_filepath"), rules).alias("target"))


@check("c13_min_segments", "SELECT l_orderkey AS id, count(*)::BIGINT AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def c13(spark, d):
    tracks = v.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list("l_linenumber").alias("segments"))
    return filters.min_segments(tracks).select("id", F.size("segments").cast("bigint").alias("n"))


@check("c13_exploded_segments", "SELECT user_id AS id, event_id FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY 1 HAVING count(*) >= 70)")
def c13b(spark, d):
    events = v.table(spark, d, "events").select(F.col("user_id").alias("id"), "event_id")
    return fallback.tracks_with_segments(events, "id", 70)


@check("c14_empty_refs", M + "SELECT row_id, CASE WHEN length(trim(regexp_replace(text, '[a-z .,]', '', 'g'))) <= 1 THEN 'empty_ref' ELSE 'kept' END AS outcome FROM manifest")
def c14(spark, d):
    rows = v.manifest(spark, d).withColumn("ref", F.regexp_replace("text", "[a-z .,]", ""))
    return outcome(filters.split_empty_refs(rows), "row_id")


@check("d1_file_exists", ML + "SELECT row_id, CASE WHEN audio_filepath IN (SELECT path FROM listing) THEN 'kept' ELSE 'missing_file' END AS outcome FROM manifest")
def d1(spark, d):
    return outcome(existence.check_exists(v.manifest(spark, d), v.listing(spark, d)), "row_id")


@check(
    "d2_keep_listed",
    ML + """SELECT row_id, string_split(audio_filepath, '/')[-1] AS wav_name FROM manifest
      WHERE string_split(audio_filepath, '/')[-1] IN (SELECT string_split(path, '/')[-1] FROM listing)""",
)
def d2(spark, d):
    from ..functions import base_name

    rows = v.manifest(spark, d).select("row_id", base_name(F.col("audio_filepath")).alias("wav_name"))
    names = v.listing(spark, d).select(base_name(F.col("path")).alias("path"))
    return existence.keep_listed(rows, names, "wav_name").select("row_id", "wav_name")


@check(
    "e1_duration_report",
    """SELECT format('{:.2f}', sum(l_quantity))::DOUBLE AS total_s, format('{:.2f}', sum(l_quantity) / 3600)::DOUBLE AS total_h,
      count_if(l_quantity = 0)::BIGINT AS n_empty, count_if(l_quantity > 30)::BIGINT AS n_long, count_if(l_quantity < 1)::BIGINT AS n_short FROM lineitem""",
)
def e1(spark, d):
    return durations.duration_report(v.table(spark, d, "lineitem"), "l_quantity")


@check("e1b_total_hours", M + "SELECT round(sum(duration), 4) AS total_s, round(sum(duration) / 3600, 6) AS total_h FROM manifest")
def e1b(spark, d):
    total = durations.total_hours(v.manifest(spark, d))
    return total.select(F.round("total_s", 4).alias("total_s"), F.round("total_h", 6).alias("total_h"))


@check("e3_exist_counts", ML + "SELECT count_if(audio_filepath IN (SELECT path FROM listing))::BIGINT AS present, count_if(audio_filepath NOT IN (SELECT path FROM listing))::BIGINT AS missing FROM manifest")
def e3(spark, d):
    return existence.exist_counts(v.manifest(spark, d), v.listing(spark, d))


@check("e4_duplicate_rows", "SELECT (count(*) - count(DISTINCT (text, lang)))::BIGINT AS duplicate_rows FROM documents")
def e4(spark, d):
    return dedupe.duplicate_rows(v.table(spark, d, "documents").select("text", "lang"))


@check("e5_duplicate_names", "SELECT (count(*) - count(DISTINCT lang || (n_chars % 50)))::BIGINT AS duplicate_names, count(DISTINCT lang || (n_chars % 50))::BIGINT AS distinct_names FROM documents")
def e5(spark, d):
    path = F.concat(F.lit("/data/"), "source", F.lit("/"), "lang", F.col("n_chars") % 50)
    return dedupe.duplicate_names(v.table(spark, d, "documents").select(path.alias("audio_filepath")))


@check("e5_used_names", "SELECT string_split(url, '/')[-1] AS base_name, count(*)::BIGINT AS n FROM pages GROUP BY 1")
def e5b(spark, d):
    return dedupe.used_names(v.table(spark, d, "pages"), "url")


@check(
    "e10_stage_counts",
    M + f"""SELECT stage, position, n::BIGINT AS n FROM (
      SELECT 'input' AS stage, 0 AS position, count(*) AS n FROM manifest
      UNION ALL SELECT 'band', 1, count_if(duration BETWEEN 1 AND 300) FROM manifest
      UNION ALL SELECT 'marker', 2, count_if(duration BETWEEN 1 AND 300 AND NOT contains(text, '|')) FROM manifest
      UNION ALL SELECT 'special', 3, count_if(duration BETWEEN 1 AND 300 AND NOT contains(text, '|') AND NOT regexp_matches(text, '{SPECIAL}')) FROM manifest)""",
)
def e10(spark, d):
    from ..functions import has_any_char

    text = F.col("text")
    stages = [("band", F.col("duration").between(1, 300)), ("marker", ~text.contains("|")), ("special", ~has_any_char(text))]
    return counting.stage_counts(v.manifest(spark, d), stages)


@check("e10_changed_rows", "SELECT count(*)::BIGINT AS n_rows, count_if(translate(text, 'é。：,，！-' || chr(10), 'e') <> text)::BIGINT AS n_changed FROM documents")
def e10b(spark, d):
    from ..functions import strip_punct

    rows = v.table(spark, d, "documents").withColumn("after", strip_punct(F.col("text")))
    return counting.changed_rows(rows, "text", "after")


@check("e11_duration_issues", "SELECT event_id AS audio_filepath, value AS duration, unnest(list_filter([CASE WHEN value = 0 THEN 'empty' END, CASE WHEN value > 30 THEN 'long' END, CASE WHEN value < 1 THEN 'short' END], lambda x: x IS NOT NULL)) AS issue FROM events")
def e11(spark, d):
    events = v.table(spark, d, "events").select(F.col("event_id").alias("audio_filepath"), F.col("value").alias("duration"))
    return durations.duration_issues(events)


@check("f1_first_by_text", "SELECT doc_id, md5(text) AS text_md5 FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def f1(spark, d):
    rows = v.table(spark, d, "documents").select("doc_id", "text")
    return dedupe.first_by_text(rows, "text", "doc_id").select("doc_id", F.md5("text").alias("text_md5"))


@check("f1_first_arrivals", "SELECT doc_id, md5(text) AS text_md5 FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id % 3, doc_id) = 1")
def f1_stream(spark, d):
    """Three parts that arrive one after another, each taken in by a run of its own that goes on from the checkpoint."""
    folder = v.scratch(spark)
    rows = v.table(spark, d, "documents").select("doc_id", "text")
    for part in range(3):
        rows.filter(F.pmod("doc_id", F.lit(3)) == part).write.mode("append").parquet(f"{folder}/inbox")
        arriving = spark.readStream.schema(rows.schema).parquet(f"{folder}/inbox")
        start_batches(first_arrivals(arriving, "text", "doc_id"), f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
    kept = spark.read.schema(rows.schema).parquet(f"{folder}/out")
    return kept.select("doc_id", F.md5("text").alias("text_md5"))


@check(
    "f3_language_fallback",
    """SELECT id, lang, n::BIGINT AS n FROM (SELECT source || '/' || (n_chars % 40) AS id, lang, count(*) AS n FROM documents GROUP BY 1, 2)
    WHERE lang <> 'en' QUALIFY row_number() OVER (PARTITION BY id ORDER BY CASE lang WHEN 'es' THEN 1 WHEN 'de' THEN 2 ELSE 3 END) = 1""",
)
def f3(spark, d):
    docs = v.table(spark, d, "documents")
    tracks = docs.groupBy(F.concat("source", F.lit("/"), F.col("n_chars") % 40).alias("id"), "lang").agg(F.count("*").alias("n"))
    return fallback.first_language(tracks, ["es", "de", "fr"])


@check(
    "p1_clean_manifest",
    M + f"""SELECT row_id, CASE WHEN duration > 300 THEN 'long' WHEN duration < 1 THEN 'short' WHEN contains(text, '[UNK]') THEN 'marker'
      WHEN regexp_matches(text, '{SPECIAL}') THEN 'special_character' WHEN length(replace(text, ' ', '')) < 1 THEN 'blank' ELSE 'kept' END AS outcome FROM manifest""",
)
def p1(spark, d):
    return judged(v.manifest(spark, d), manifest_reason(1, 300), "row_id")
