"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.counting import record_count
from ..operators.existence import manifest_from_tsv
from ..operators.segments import audit_format
from ..sources import (
    append_step_scores,
    clean_lines,
    list_files,
    manifest_from_csv,
    manifest_from_textgrid,
    parse_sanity_lines,
    parse_subtitles,
    preflight,
    probe_wav,
    read_manifest,
    read_splits,
    sanity_manifest,
    urls_from_ids,
    write_manifest,
    write_shards,
    write_splits,
    write_subtitles,
)
from . import views as v
from ..sources.textgrid import text_of
from .registry import ORACLES, check


@check(
    "a1_read_manifest",
    v.with_views(v.MANIFEST)
    + "SELECT audio_filepath, format('{:.2f}', duration)::DOUBLE AS duration, md5(text) AS text_md5 FROM manifest",
)
def a1(spark, d):
    from ..sources.manifest import rounded_manifest

    path = v.scratch(spark)
    write_manifest(rounded_manifest(v.manifest(spark, d)), path)
    rows = read_manifest(spark, path).filter("_corrupt_record IS NULL")
    return rows.select("audio_filepath", "duration", F.md5("text").alias("text_md5"))


@check(
    "a1_row_numbers",
    v.with_views(v.MANIFEST) + "SELECT min(row_id)::BIGINT AS first_id, (count(*) - 1)::BIGINT AS last_id, count(*)::BIGINT AS n_ids FROM manifest",
)
def a1_rows(spark, d):
    path = v.scratch(spark)
    write_manifest(v.manifest(spark, d), path)
    numbered = read_manifest(spark, path, row_id=True)
    return numbered.agg(
        F.min("row_id").alias("first_id"), F.max("row_id").alias("last_id"), F.count_distinct("row_id").alias("n_ids")
    )


@check(
    "a3_csv_lines",
    v.with_views(v.MANIFEST)
    + r"""SELECT row_id, CASE WHEN NOT regexp_full_match(d, '\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*') THEN 'bad_duration'
      WHEN d::DOUBLE > 30 THEN 'long' WHEN d::DOUBLE < 1 THEN 'short' ELSE 'kept' END AS outcome,
      path AS audio_filepath
    FROM (SELECT row_id, split_part(line, ',', 3) AS d, regexp_replace(split_part(line, ',', 1), '^.*waves/', '') AS path
      FROM (SELECT row_id, '/d/waves/' || row_id || '.wav,' || text || ',' || (duration / 8)::DECIMAL(12,2) AS line FROM manifest))""",
)
def a3(spark, d):
    line = F.concat(F.lit("/d/waves/"), "row_id", F.lit(".wav,"), "text", F.lit(","), (F.col("duration") / 8).cast("decimal(12,2)"))
    kept, rejects = manifest_from_csv(v.manifest(spark, d).select("row_id", line.alias("value")))
    both = kept.withColumn("reason", F.lit("kept")).unionByName(rejects)
    return both.select("row_id", F.col("reason").alias("outcome"), "audio_filepath")


@check(
    "a4_tsv_table",
    v.with_views(v.MANIFEST, v.LISTING, v.MIXED)
    + """, clips AS (SELECT doc_id, lang || '_' || (length(text) % 97) || '.wav' AS wav, text FROM mixed),
    first AS (SELECT * FROM clips QUALIFY row_number() OVER (PARTITION BY wav ORDER BY doc_id) = 1)
    SELECT wav AS audio_filepath, md5(split_part(text, '（', 1)) AS text_md5 FROM first
    WHERE wav IN (SELECT lang || '_' || (n_chars % 89) || '.wav' FROM documents)""",
)
def a4(spark, d):
    table = v.mixed(spark, d).select(
        F.concat("lang", F.lit("_"), F.length("text") % 97, F.lit(".mp3")).alias("path"),
        F.col("text").alias("sentence"),
        F.col("doc_id").alias("row_id"),
    )
    docs = v.table(spark, d, "documents")
    listing = docs.select(F.concat("lang", F.lit("_"), F.col("n_chars") % 89, F.lit(".wav")).alias("path"))
    rows = manifest_from_tsv(table, listing)
    return rows.select("audio_filepath", F.md5("text").alias("text_md5"))


def _textgrids(spark, d):
    """One grid per conversation with an interval per turn."""
    turns = v.segments(spark, d)
    quoted = F.replace("text", F.lit('"'), F.lit('""'))
    interval = F.format_string(
        '        intervals [%d]:\n            xmin = %s\n            xmax = %s\n            text = "%s"\n',
        F.col("turn") + 1, F.col("lo").cast("string"), F.col("hi").cast("string"), quoted,
    )
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", interval.alias("t")))), lambda x: x["t"]), "")
    head = 'File type = "ooTextFile"\nObject class = "TextGrid"\n\nitem []:\n    item [1]:\n        class = "IntervalTier"\n'
    return turns.groupBy("conv_id").agg(F.concat(F.lit(head), body).alias("value")).select(
        F.concat(F.lit("/grids/part_call_"), "conv_id", F.lit(".TextGrid")).alias("path"), "value"
    )


@check(
    "a5_textgrid",
    v.with_views(v.SEGMENTS)
    + r"""SELECT 'part_' || base || '_0000_' || regexp_replace(format('{:.2f}', lo), '(\.\d)0$', '\1') || '_'
      || regexp_replace(format('{:.2f}', hi), '(\.\d)0$', '\1') || '.wav' AS audio_filepath,
      format('{:.2f}', hi - lo)::DOUBLE AS duration, md5(text) AS text_md5,
      CASE WHEN hi - lo > 12 THEN 'long' WHEN hi - lo < 3 THEN 'short' ELSE 'kept' END AS outcome FROM segments WHERE text <> ''""",
)
def a5(spark, d):
    kept, rejects = manifest_from_textgrid(_textgrids(spark, d), 3, 12)
    both = kept.withColumn("reason", F.lit("kept")).unionByName(rejects)
    return both.select("audio_filepath", "duration", F.md5("text").alias("text_md5"), F.col("reason").alias("outcome"))


@check("a5_short_textgrid", ORACLES["a5_textgrid"])
def a5_short(spark, d):
    """The same grids in the short layout, a tier of points before the intervals, every other file in UTF-16."""
    turns = v.segments(spark, d)
    item = F.format_string('%s\n%s\n"%s"\n', F.col("lo").cast("string"), F.col("hi").cast("string"), F.replace("text", F.lit('"'), F.lit('""')))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", item.alias("t")))), lambda x: x["t"]), "")
    head = 'File type = "ooTextFile"\nObject class = "TextGrid"\n\n0\n99\n<exists>\n2\n"TextTier"\n"IntervalTier"\n0\n99\n1\n0.5\n"p ""q"""\n"IntervalTier"\n"words"\n0\n99\n'
    whole = turns.groupBy("conv_id").agg(F.concat(F.lit(head), F.count("*").cast("string"), F.lit("\n"), body).alias("value"))
    content = F.when(F.pmod("conv_id", F.lit(2)) == 0, F.encode("value", "UTF-16")).otherwise(F.encode("value", "UTF-8"))
    files = whole.select(F.concat(F.lit("/grids/part_call_"), "conv_id", F.lit(".TextGrid")).alias("path"), text_of(content).alias("value"))
    kept, rejects = manifest_from_textgrid(files, 3, 12)
    both = kept.withColumn("reason", F.lit("kept")).unionByName(rejects)
    return both.select("audio_filepath", "duration", F.md5("text").alias("text_md5"), F.col("reason").alias("outcome"))


@check(
    "a6_sanity_lines",
    v.with_views(v.REFS, v.PREDICTIONS)
    + r"""SELECT audio_filepath, checkpoint, CASE WHEN role = 'user' THEN 'cer' ELSE 'wer' END AS metric,
      length(hyp)::DOUBLE AS rate, md5(regexp_replace(text, '\n', ' ', 'g')) AS ref_md5,
      md5(regexp_replace(hyp, '\n', ' ', 'g')) AS hyp_md5
    FROM predictions JOIN refs USING (audio_filepath)""",
)
def a6(spark, d):
    from ..operators.scoring import pair

    pairs = pair(v.refs(spark, d), v.predictions(spark, d))
    ref, hyp = (F.regexp_replace(c, "\n", " ") for c in ("ref", "hyp"))
    rate = F.length("hyp").cast("double").cast("string")
    cer_line = F.concat("audio_filepath", F.lit(": {'cer': "), rate, F.lit("} ref:"), ref, F.lit(" : pred:"), hyp)
    wer_line = F.concat(
        F.lit("AUDIO FILENAME: "), "audio_filepath", F.lit(" |  WER RATE: "), rate, F.lit(" |  gt text: "), ref, F.lit(" |  pred text: "), hyp
    )
    lines = pairs.select("checkpoint", F.when(F.col("role") == "user", cer_line).otherwise(wer_line).alias("value"))
    parsed = parse_sanity_lines(lines).kept
    return parsed.select("audio_filepath", "checkpoint", "metric", "rate", F.md5("ref").alias("ref_md5"), F.md5("hyp").alias("hyp_md5"))


@check(
    "a7_subtitles",
    v.with_views(v.SEGMENTS)
    + """SELECT 'vid' || conv_id AS video_id, lo AS start, hi - lo AS duration, md5(text) AS text_md5 FROM segments""",
)
def a7(spark, d):
    escaped = F.replace(F.replace(F.replace("text", F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("\n"), F.lit("\\n"))
    line = F.format_string("{'text': '%s', 'start': %s, 'duration': %s},", escaped, F.col("lo").cast("string"), (F.col("hi") - F.col("lo")).cast("string"))
    lines = v.segments(spark, d).select(F.concat(F.lit("/subs/vid"), "conv_id", F.lit(".txt")).alias("path"), line.alias("value"))
    return parse_subtitles(lines).kept.select("video_id", "start", "duration", F.md5("text").alias("text_md5"))


@check(
    "a8_probe_wav",
    """SELECT '/waves/vec' || vec_id || '.wav' AS path, 1 AS channels,
      CASE WHEN label = 0 THEN 16000 ELSE 8000 + label * 1000 END AS sample_rate, 16 AS bits, (len(embedding) * 2)::BIGINT AS data_bytes,
      round(len(embedding) / (CASE WHEN label = 0 THEN 16000 ELSE 8000 + label * 1000 END)::DOUBLE, 9) AS duration FROM embeddings""",
)
def a8(spark, d):
    probed = probe_wav(v.wav_files(spark, d)).kept
    return probed.select("path", "channels", "sample_rate", "bits", "data_bytes", F.round("duration", 9).alias("duration"))


@check(
    "a9_clean_lines",
    r"""SELECT doc_id, count(*)::BIGINT AS n_lines, md5(string_agg(line, chr(10) ORDER BY pos)) AS lines_md5
    FROM (SELECT doc_id, pos, regexp_replace(raw, '[\s\p{Z}\x1c-\x1f\x85]+$', '') AS line
      FROM (SELECT doc_id, unnest(w) AS raw, unnest(range(len(w))) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS w FROM documents)))
    WHERE line <> '' AND NOT regexp_matches(line, 'Subject:|From:|Date:|To:') AND len(string_split(line, ' ')) > 1 GROUP BY doc_id""",
)
def a9(spark, d):
    lines = v.table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "value"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"])
    return clean_lines(lines).groupBy("doc_id").agg(
        F.count("*").alias("n_lines"), F.md5(F.array_join(ordered, "\n")).alias("lines_md5")
    )


@check("a10_splits", "SELECT doc_id AS row_id, CASE lang WHEN 'en' THEN 'train' WHEN 'fr' THEN 'test' ELSE 'validation' END AS split FROM documents WHERE lang <> 'en'")
def a10(spark, d):
    path = v.scratch(spark)
    part = F.when(F.col("lang") == "en", "train").when(F.col("lang") == "fr", "test").otherwise("validation")
    write_splits(v.manifest(spark, d).withColumn("split", part), path)
    rows = read_splits(spark, path).filter("split IN ('test', 'validation')")
    return rows.select(F.regexp_extract("audio_filepath", r"\[(\d+)\]", 1).cast("bigint").alias("row_id"), "split")


@check("a11_watch_urls", "SELECT doc_id, 'https://www.youtube.com/watch?v=' || source || '-' || doc_id AS url FROM documents")
def a11(spark, d):
    ids = v.table(spark, d, "documents").select("doc_id", F.concat("source", F.lit("-"), "doc_id").alias("id"))
    return urls_from_ids(ids).select("doc_id", "url")


@check(
    "a12_preflight",
    v.with_views(v.MANIFEST, v.LISTING)
    + """SELECT (SELECT count(DISTINCT lang) FROM manifest)::BIGINT AS n_files,
      (SELECT count(*) FROM manifest WHERE audio_filepath NOT IN (SELECT path FROM listing))::BIGINT AS n_missing, false AS ready""",
)
def a12(spark, d):
    rows = v.manifest(spark, d)
    return preflight(rows.select("lang").distinct(), rows, v.listing(spark, d))


@check(
    "a12_preflight_ready",
    v.with_views(v.MANIFEST, v.LISTING)
    + """, there AS (SELECT * FROM manifest WHERE audio_filepath IN (SELECT path FROM listing)),
      n AS (SELECT count(DISTINCT lang) AS n FROM there)
    SELECT n::BIGINT AS n_files, 0::BIGINT AS n_missing, n >= least AS ready FROM n, (VALUES (2), (1000)) t(least)""",
)
def a12_ready(spark, d):
    """Audio is there for every row; the files are enough for one training run and too few for another."""
    listing = v.listing(spark, d)
    rows = v.manifest(spark, d).join(listing.withColumnRenamed("path", "audio_filepath"), "audio_filepath", "left_semi")
    files = rows.select("lang").distinct()
    return preflight(files, rows, listing).unionByName(preflight(files, rows, listing, least=1000))


@check(
    "b1_write_manifest",
    v.with_views(v.MANIFEST) + "SELECT audio_filepath, duration, md5(text) AS text_md5, (SELECT count(*) FROM manifest)::BIGINT AS n_written FROM manifest",
)
def b1(spark, d):
    path = v.scratch(spark)
    written = write_manifest(v.manifest(spark, d), path)
    return read_manifest(spark, path).select("audio_filepath", "duration", F.md5("text").alias("text_md5"), F.lit(written).alias("n_written"))


@check(
    "b3_subtitle_files",
    v.with_views(v.SEGMENTS) + """SELECT 'vid' || conv_id AS video_id, count(*)::BIGINT AS n, round(sum(lo), 6) AS starts FROM segments GROUP BY 1""",
)
def b3(spark, d):
    path = v.scratch(spark)
    rows = v.segments(spark, d).select(
        F.concat(F.lit("vid"), "conv_id").alias("video_id"), "text", F.col("lo").alias("start"), (F.col("hi") - F.col("lo")).alias("duration")
    )
    write_subtitles(rows, path)
    back = spark.read.schema("text string, start double, duration double, video_id string").json(path)
    return back.groupBy("video_id").agg(F.count("*").alias("n"), F.round(F.sum("start"), 6).alias("starts"))


@check(
    "b4_step_scores",
    "SELECT 1 AS step, event_id, event_type, value FROM events WHERE event_type = 'click' UNION ALL SELECT 2, event_id, event_type, value FROM events",
)
def b4(spark, d):
    """The second step is written twice; the second time replaces the first."""
    path = v.scratch(spark)
    events = v.table(spark, d, "events").select("event_id", "event_type", "value")
    for step, rows in ((1, events.filter("event_type = 'click'")), (2, events.filter("event_type = 'view'")), (2, events)):
        append_step_scores(rows, step, path)
    return spark.read.parquet(path)


@check(
    "b5_shards",
    v.with_views(v.MANIFEST)
    + """SELECT floor(('0x' || substr(md5(audio_filepath || '|0'), 1, 8))::BIGINT / 4294967296.0::DOUBLE * 7)::INTEGER AS shard, audio_filepath, md5(text) AS text_md5
      FROM manifest""",
)
def b5(spark, d):
    path = v.scratch(spark)
    write_shards(v.manifest(spark, d).select("audio_filepath", "text"), path, 7)
    back = spark.read.schema("audio_filepath string, text string, shard int").json(path)
    return back.select("shard", "audio_filepath", F.md5("text").alias("text_md5"))


@check("e2_record_count", "SELECT count(*)::BIGINT AS n_records FROM documents")
def e2(spark, d):
    return record_count(v.manifest(spark, d))


@check(
    "t24_format_audit",
    "SELECT label, (label IN (0, 8)) AS conforms, count(*)::BIGINT AS n FROM embeddings GROUP BY ALL",
)
def t24(spark, d):
    files = v.wav_files(spark, d)
    probed = audit_format(probe_wav(files).kept)
    labels = v.table(spark, d, "embeddings").select(F.concat(F.lit("/waves/vec"), "vec_id", F.lit(".wav")).alias("path"), "label")
    return probed.join(labels, "path").groupBy("label", "conforms").agg(F.count("*").alias("n"))


@check(
    "q9_sanity_manifest",
    v.with_views(v.MIXED)
    + r"""SELECT 'clip_' || doc_id AS audio_filepath,
      md5(regexp_replace(regexp_replace(translate(text, ' ,、', ''), '(\p{Han})([A-Za-z0-9])', '\1 \2', 'g'), '([A-Za-z0-9])(\p{Han})', '\1 \2', 'g')) AS text_md5
    FROM mixed""",
)
def q9(spark, d):
    parsed = v.mixed(spark, d).select(F.concat(F.lit("clip_"), "doc_id").alias("audio_filepath"), F.col("text").alias("ref"))
    return sanity_manifest(parsed, clean=True).select("audio_filepath", F.md5("text").alias("text_md5"))


@check("a2_list_files", "SELECT lang AS folder, 1::BIGINT AS n_files, true AS all_sized FROM documents GROUP BY lang")
def a2(spark, d):
    """One file is written below each folder, and found there."""
    path = v.scratch(spark)
    v.manifest(spark, d).select("lang", "text").hint("rebalance", F.col("lang")).write.partitionBy("lang").json(path)
    files = list_files(spark, path, "*.json").withColumn("folder", F.regexp_extract("path", "lang=([a-z]+)/", 1))
    # A large folder may be split into several files.
    return files.groupBy("folder").agg(F.least(F.count("*"), F.lit(1)).cast("bigint").alias("n_files"), F.every(F.col("length") > 0).alias("all_sized"))
