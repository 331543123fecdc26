"""Files per key, WAV files by byte ranges, and their conversion, on files written from the tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pcm
from ..functions.paths import base_name
from ..functions.wav import pcm_bytes, pcm_header
from ..operators import combine, mixdown, resample
from ..session import spread
from ..sources.keyed_files import write_keyed, write_subtitle_files
from ..sources.lines import parse_subtitles
from ..sources.manifest import list_files
from ..sources.wav_ranges import cut_ranges, probe_ranges, wav_listing
from . import views as v
from .registry import check
from .set_checks import rank_sql, unit_sql


def written(spark, files: DataFrame) -> DataFrame:
    """The listing of (path, content) rows after each has been written to a file of its own."""
    folder = v.scratch(spark)
    write_keyed(files, folder, base_name(F.col("path")), F.col("content"))
    return wav_listing(spark, folder)


@check(
    "b3_file_per_id",
    v.with_views(v.SEGMENTS)
    + """SELECT 'vid' || conv_id AS video_id, 1::BIGINT AS n_files, count(*)::BIGINT AS n, round(sum(lo), 6) AS starts,
      md5(string_agg(md5(text), ',' ORDER BY lo, md5(text))) AS texts_md5 FROM segments GROUP BY 1""",
)
def b3(spark, d):
    """Files of one line per segment, read back as files that were downloaded."""
    folder = v.scratch(spark)
    rows = v.segments(spark, d).select(F.concat(F.lit("vid"), "conv_id").alias("video_id"), "text", F.col("lo").alias("start"), (F.col("hi") - F.col("lo")).alias("duration"))
    write_subtitle_files(rows, folder)
    lines = spark.read.text(folder).select(F.col("_metadata.file_path").alias("path"), "value")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("start", F.md5("text").alias("m")))), lambda x: x["m"])
    back = parse_subtitles(lines).kept.groupBy("video_id").agg(F.count("*").alias("n"), F.round(F.sum("start"), 6).alias("starts"), F.md5(F.array_join(texts, ",")).alias("texts_md5"))
    files = list_files(spark, folder).groupBy(F.regexp_extract("path", r"([^/]*)\.txt$", 1).alias("video_id")).agg(F.count("*").alias("n_files"))
    return files.join(back, "video_id").select("video_id", "n_files", "n", "starts", "texts_md5")


@check(
    "a8_probe_ranges",
    """SELECT 'vec' || vec_id || '.wav' AS name, CASE WHEN vec_id % 3 = 0 THEN 3 ELSE 1 END AS tag, CASE WHEN vec_id % 3 = 0 THEN 32 ELSE 16 END AS bits,
      (len(embedding) * CASE WHEN vec_id % 3 = 0 THEN 4 ELSE 2 END)::BIGINT AS data_bytes, round(len(embedding) / 16000::DOUBLE, 9) AS duration,
      CASE WHEN vec_id % 3 = 1 THEN 100 ELSE 0 END AS other_chunks FROM embeddings""",
)
def a8(spark, d):
    """Every third file holds floating-point samples, every third has a hundred other chunks before its samples."""
    whole, kind = pcm_bytes(F.col("embedding")), F.pmod("vec_id", F.lit(3))
    plain = pcm_header(F.octet_length(whole), F.lit(16000), F.lit(1), F.lit(16))
    notes = F.unhex(F.repeat(F.lit("4E4F5445" + "06000000" + "000102030405"), 100))
    head = pcm.header(0, 16000, 1, 32, pcm.FLOATS)[:40]
    floats = F.flatten(F.transform("embedding", lambda x: F.array(x)))
    bits = _float_bytes(floats)
    content = (
        F.when(kind == 0, F.concat(F.lit(head), F.unhex(_length(F.octet_length(bits))), bits))
        .when(kind == 1, F.concat(F.substring(plain, 1, 36), notes, F.substring(plain, 37, 8), whole))
        .otherwise(F.concat(plain, whole))
    )
    files = v.table(spark, d, "embeddings").select(F.concat(F.lit("/waves/vec"), "vec_id", F.lit(".wav")).alias("path"), content.alias("content"))
    probed = probe_ranges(written(spark, files)).kept
    others = ((F.col("data_at") - 44) / 14).cast("int").alias("other_chunks")
    return probed.select(base_name(F.col("path")).alias("name"), "tag", "bits", "data_bytes", F.round("duration", 9).alias("duration"), others)


def _length(n):
    from ..functions.wav import little_endian

    return little_endian(n, 4)


def _float_bytes(samples):
    """Samples as 32-bit floating-point numbers, in an Arrow function: Spark has no expression for their bits."""

    @F.arrow_udf("binary")
    def packed(rows: pa.Array) -> pa.Array:
        return pa.array([np.asarray(r.as_py(), "<f4").tobytes() for r in rows], pa.binary())

    return packed(samples)


@check(
    "t23_cut_ranges",
    """WITH c AS (SELECT vec_id, flatten(list_transform(range(8), lambda i: embedding)) AS x FROM embeddings),
    w AS (SELECT vec_id, list_transform(x, lambda v: (round(greatest(least(v, 1.0), -1.0)::DOUBLE * 32767)::BIGINT % 65536 + 65536) % 65536) AS pcm FROM c),
    s AS (SELECT vec_id, part, pcm[1 + lo:hi] AS cut FROM w, (VALUES (0, 160, 320), (1, 400, 512)) p(part, lo, hi))
    SELECT vec_id, part::INTEGER AS part, (2 * len(cut))::BIGINT AS data_bytes,
      md5(array_to_string(list_transform(cut, lambda v: printf('%02X%02X', v % 256, v // 256)), '')) AS bytes_md5 FROM s""",
)
def t23(spark, d):
    """Pieces from inside recordings, of which only their own bytes are read."""
    data = pcm_bytes(F.flatten(F.array_repeat("embedding", 8)))
    head = pcm_header(F.octet_length(data), F.lit(16000), F.lit(1), F.lit(16))
    tapes = v.table(spark, d, "embeddings").select(F.concat(F.lit("vec"), "vec_id", F.lit(".wav")).alias("path"), F.concat(head, data).alias("content"))
    parts = F.array(*[F.struct(F.lit(n).alias("part"), F.lit(f"_0000_{a}_{b}.wav").alias("name")) for n, a, b in ((0, "0.01", "0.02"), (1, "0.025", "9.0"))])
    clips = v.table(spark, d, "embeddings").select("vec_id", F.inline(parts)).select("vec_id", "part", F.concat(F.lit("vec"), "vec_id", "name").alias("audio_filepath"))
    cut = cut_ranges(clips, probe_ranges(written(spark, tapes)).kept).kept
    samples = F.substring("content", 45, F.col("data_bytes").cast("int"))
    return cut.select("vec_id", "part", "data_bytes", F.md5(F.hex(samples)).alias("bytes_md5"))


@check(
    "t24_convert",
    f"""WITH s AS (SELECT vec_id, CASE WHEN label = 0 THEN 16000 ELSE 8000 + label * 1000 END AS fi,
        list_transform(embedding, lambda v: round(greatest(least(v, 1.0), -1.0)::DOUBLE * 32767)::BIGINT) AS x FROM embeddings),
    r AS (SELECT vec_id, x, (16000 // gcd(fi, 16000))::BIGINT AS up, (fi // gcd(fi, 16000))::BIGINT AS down FROM s),
    q AS (SELECT *, {resample.BAND}::DOUBLE * least(1.0::DOUBLE, up::DOUBLE / down) AS cut, CASE WHEN up = down THEN 0 ELSE ceil({resample.ZEROS} * greatest(1.0::DOUBLE, down::DOUBLE / up) / {resample.BAND}::DOUBLE)::BIGINT END AS half FROM r),
    m AS (SELECT *, unnest(range((len(x) * up + down - 1) // down)) AS m FROM q),
    w AS (SELECT vec_id, m, up, down, cut, x, (m * down) // up AS spot, ((m * down) % up)::DOUBLE / up AS phase, unnest(CASE WHEN up = down THEN [0::BIGINT] ELSE range(1 - half, half + 1) END) AS j FROM m),
    t AS (SELECT vec_id, m, CASE WHEN spot + j >= 0 AND spot + j < len(x) THEN x[spot + j + 1] ELSE 0 END AS v, CASE WHEN up = down THEN 1.0::DOUBLE
        WHEN abs(j - phase) >= {resample.ZEROS} / cut THEN 0.0::DOUBLE
        ELSE (CASE WHEN j = phase THEN 1.0::DOUBLE ELSE sin(pi() * cut * (j - phase)) / (pi() * cut * (j - phase)) END) * pow(cos(pi() * (j - phase) * cut / (2 * {resample.ZEROS})), 2) END AS g FROM w),
    y AS (SELECT vec_id, m, greatest(-32768, least(32767, floor(sum(v * g) / sum(g) + 0.5)))::BIGINT AS y FROM t GROUP BY vec_id, m)
    SELECT vec_id, count(*)::BIGINT AS samples, md5(string_agg(y::VARCHAR, ',' ORDER BY m)) AS samples_md5 FROM y GROUP BY vec_id""",
)
def t24(spark, d):
    """Files of all rates at 16 kHz, in chunks of 50 samples, written as files and read again."""
    folder = v.scratch(spark)
    resample.write_converted(probe_ranges(written(spark, v.wav_files(spark, d))).kept, folder, chunk=50)
    back = spread(spark.read.format("binaryFile").load(folder).select("path", "content"))
    name = F.regexp_extract("path", r"vec([0-9]+)\.wav$", 1).cast("long").alias("vec_id")
    return back.select(name, ((F.length("content") - 44) / 2).cast("long").alias("samples"), F.md5(_levels(F.col("content"))).alias("samples_md5"))


def _levels(content):
    """The 16-bit samples behind a header of 44 bytes as numbers with commas between."""

    @F.arrow_udf("string")
    def listed(files: pa.Array) -> pa.Array:
        return pa.array([",".join(map(str, np.frombuffer(f.as_buffer(), "<i2", offset=44).tolist())) if f.is_valid else None for f in files], pa.string())

    return listed(content)


# Recordings of a thousand samples a second, so that milliseconds are samples. Values in steps of 16 bits.
RATE = 1000
TAPES = """tapes AS (SELECT 'vec' || vec_id || '.wav' AS path, len(embedding)::BIGINT AS n,
  list_transform(embedding, lambda v: round(greatest(least(v, 1.0), -1.0)::DOUBLE * 32767)::BIGINT) AS x FROM embeddings)"""
MIXED_SQL = """laid AS (SELECT t.out, t.at, t.path, x, t.at + n AS stop FROM tracks t JOIN tapes USING (path)),
    total AS (SELECT out, max(stop)::BIGINT AS samples FROM laid GROUP BY 1),
    spots AS (SELECT out, p.at + i AS spot, p.x[i + 1] AS v FROM laid p, LATERAL (SELECT unnest(range(len(p.x))) AS i)),
    sums AS (SELECT out, spot, greatest(-32768, least(32767, sum(v)))::BIGINT AS y FROM spots GROUP BY 1, 2),
    every AS (SELECT out, samples, unnest(range(samples)) AS spot FROM total)
    SELECT out, max(samples)::BIGINT AS samples, md5(string_agg(coalesce(y, 0)::VARCHAR, ',' ORDER BY spot)) AS samples_md5
    FROM every LEFT JOIN sums USING (out, spot) GROUP BY out"""


def tapes(spark, d) -> DataFrame:
    """(path, first_out, pcm) of recordings written to files and read again, 50 samples a row."""
    data = pcm_bytes(F.col("embedding"))
    head = pcm_header(F.octet_length(data), F.lit(RATE), F.lit(1), F.lit(16))
    files = v.table(spark, d, "embeddings").select(F.concat(F.lit("vec"), "vec_id", F.lit(".wav")).alias("path"), F.concat(head, data).alias("content"))
    chunks = resample.convert(probe_ranges(written(spark, files)).kept, RATE, chunk=50)
    return chunks.withColumn("path", base_name(F.col("path")))


def heard(spark, folder: str) -> DataFrame:
    """Samples of the files in a folder, as signed numbers."""
    files = spread(spark.read.format("binaryFile").load(folder).select("path", "content"))
    name = F.regexp_extract("path", r"([^/]*)\.wav$", 1)
    return files.select(name.alias("out"), ((F.length("content") - 44) / 2).cast("long").alias("samples"), F.md5(_levels(F.col("content"))).alias("samples_md5"))


@check(
    "x5_overtalk_samples",
    "WITH " + TAPES
    + f""", k AS (SELECT path, n / 1000::DOUBLE AS length, {unit_sql('path', '5', "'half'")} < 0.5 AS half, {rank_sql('path', '5', "'order'")} AS o FROM tapes),
    r AS (SELECT *, row_number() OVER (PARTITION BY half ORDER BY o, path) AS rk FROM k),
    m AS (SELECT a.path AS p1, b.path AS p2, a.length - format('{{:.3f}}', {unit_sql('a.path', 'b.path', '5')} * least(0.05::DOUBLE, a.length, b.length))::DOUBLE AS late
      FROM r a JOIN r b USING (rk) WHERE a.half AND NOT b.half),
    tracks AS (SELECT p1 || '+' || p2 AS out, p1 AS path, 0::BIGINT AS at FROM m UNION ALL SELECT p1 || '+' || p2, p2, round(late * 1000)::BIGINT FROM m),
    """
    + MIXED_SQL,
)
def x5_samples(spark, d):
    """Pairs of recordings, the second starting before the first ends, mixed in frames of 64 samples."""
    timed = v.table(spark, d, "embeddings").select(
        F.concat(F.lit("vec"), "vec_id", F.lit(".wav")).alias("audio_filepath"), F.lit(0).alias("pos"), F.lit("w").alias("word"), F.lit(0.0).alias("start"), (F.size("embedding") / RATE).alias("end")
    )
    plan = combine.overtalk(timed, seed=5, max_overlap=0.05).kept
    folder = v.scratch(spark)
    mixdown.write_mix(mixdown.mix_down(mixdown.overtalk_tracks(plan, RATE), tapes(spark, d), frame=64).kept, folder, RATE)
    return heard(spark, folder)


@check(
    "x6_backchannel_samples",
    "WITH " + TAPES
    + f""", g AS (SELECT path, {unit_sql('path', '0', '0', "'word'")} < 0.5 AS okay, {unit_sql('path', '0', '0', "'gate'")} AS gate FROM tapes),
    tracks AS (SELECT regexp_replace(path, '[.]wav$', '') AS out, path, 0::BIGINT AS at FROM tapes
      UNION ALL SELECT regexp_replace(path, '[.]wav$', ''), CASE WHEN okay THEN 'vec0.wav' ELSE 'vec1.wav' END, CASE WHEN okay THEN 12 ELSE 16 END::BIGINT FROM g WHERE gate < 0.7),
    """
    + MIXED_SQL,
)
def x6_samples(spark, d):
    """Two words a recording with a pause between them; the inserted word sounds as one of two recordings."""
    name = F.concat(F.lit("vec"), "vec_id", F.lit(".wav")).alias("audio_filepath")
    spoken = F.array(
        F.struct(F.lit(0).alias("pos"), F.lit("a").alias("word"), F.lit(0.0).alias("start"), F.lit(0.01).alias("end")),
        F.struct(F.lit(1).alias("pos"), F.lit("b").alias("word"), F.lit(0.03).alias("start"), F.lit(0.06).alias("end")),
    )
    timed = v.table(spark, d, "embeddings").select(name, F.inline(spoken))
    worded = combine.insert_backchannels(timed, [("okay", 0.016), ("yes", 0.008)], share=0.7)
    clips = spark.createDataFrame([("okay", "vec0.wav"), ("yes", "vec1.wav")], "word string, path string")
    tracks = mixdown.backchannel_tracks(worded, clips, RATE).withColumn("out", F.regexp_replace("out", "[.]wav$", ""))
    folder = v.scratch(spark)
    mixdown.write_mix(mixdown.mix_down(tracks, tapes(spark, d), frame=64).kept, folder, RATE)
    return heard(spark, folder)
