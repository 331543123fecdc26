"""The driver's tables seen as speech data. Each view exists twice: as a DataFrame and as SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder, spread
from ..functions.wav import pcm_bytes, pcm_header


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared one the session names."""
    return f"{shared_folder(spark)}/voxloom-{uuid.uuid4().hex}"


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("row_id"),
        F.concat(F.lit("/corpus/"), "source", F.lit("/["), "doc_id", F.lit("].wav")).alias("audio_filepath"),
        "text",
        (F.col("n_chars") / 15.0).alias("duration"),
        "lang",
        "source",
    )


MANIFEST = """manifest AS (
  SELECT doc_id AS row_id, '/corpus/' || source || '/[' || doc_id || '].wav' AS audio_filepath, text,
    n_chars / 15.0::DOUBLE AS duration, lang, source FROM documents)"""


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """Files exist for the labelled documents."""
    labelled = table(spark, folder, "labels").select(F.col("doc_id").alias("row_id"))
    return manifest(spark, folder).join(labelled, "row_id", "left_semi").select(F.col("audio_filepath").alias("path"))


LISTING = """listing AS (
  SELECT audio_filepath AS path FROM manifest WHERE row_id IN (SELECT doc_id FROM labels))"""


def refs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").select(
        F.concat(F.lit("/calls/"), "conv_id", F.lit("_"), "turn", F.lit(".wav")).alias("audio_filepath"),
        "text",
        "role",
    )


REFS = """refs AS (
  SELECT '/calls/' || conv_id || '_' || turn || '.wav' AS audio_filepath, text, role FROM conversations)"""

CHECKPOINTS = ("checkpoint-30", "checkpoint-200", "checkpoint-1000", "checkpoint-2000")


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Four models, each hearing the reference wrong in its own way."""
    text = F.col("text")
    short = F.regexp_replace(text, " [a-z]{2} ", " ")
    heard = F.array(
        F.regexp_replace(short, "[aeiou]n", "xx"),
        F.regexp_replace(F.regexp_replace(text, " ([a-z]{3}) ", " $1 $1 "), "on", "xx"),
        F.regexp_replace(short, " ([a-z]{4}) ", " $1 the "),
        F.replace(text, F.lit("e "), F.lit(" ")),
    )
    names = F.array(*[F.lit(n) for n in CHECKPOINTS])
    both = F.arrays_zip(names.alias("checkpoint"), heard.alias("hyp"))
    return refs(spark, folder).select("audio_filepath", F.inline(both)).select("checkpoint", "audio_filepath", "hyp")


PREDICTIONS = r"""predictions AS (
  SELECT 'checkpoint-30' AS checkpoint, audio_filepath,
    regexp_replace(regexp_replace(text, ' [a-z]{2} ', ' ', 'g'), '[aeiou]n', 'xx', 'g') AS hyp FROM refs
  UNION ALL SELECT 'checkpoint-200', audio_filepath,
    regexp_replace(regexp_replace(text, ' ([a-z]{3}) ', ' \1 \1 ', 'g'), 'on', 'xx', 'g') FROM refs
  UNION ALL SELECT 'checkpoint-1000', audio_filepath,
    regexp_replace(regexp_replace(text, ' [a-z]{2} ', ' ', 'g'), ' ([a-z]{4}) ', ' \1 the ', 'g') FROM refs
  UNION ALL SELECT 'checkpoint-2000', audio_filepath, replace(text, 'e ', ' ') FROM refs)"""


def mixed(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with some letters turned into Han characters, in another script per language."""
    text = F.col("text")
    han = (
        F.when(F.col("lang") == "en", F.translate(text, "st(,", "汉语（，"))
        .when(F.col("lang") == "fr", F.translate(text, "st(,", "漢語（，"))
        .when(F.col("lang") == "de", F.translate(text, "st(,", "中文（，"))
        .otherwise(text)
    )
    # What is done to these texts, letter by letter, costs far more than moving them.
    return spread(table(spark, folder, "documents")).select("doc_id", "lang", "source", han.alias("text"))


MIXED = """mixed AS (
  SELECT doc_id, lang, source, CASE lang WHEN 'en' THEN translate(text, 'st(,', '汉语（，')
    WHEN 'fr' THEN translate(text, 'st(,', '漢語（，') WHEN 'de' THEN translate(text, 'st(,', '中文（，') ELSE text END AS text
  FROM documents)"""

SCRIPT_TABLE = [("汉", "漢"), ("语", "語"), ("国", "國")]


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """Named segments: turns of a conversation, one after another."""
    turns = table(spark, folder, "conversations")
    return turns.select(
        "conv_id", "turn", F.concat(F.lit("call_"), "conv_id").alias("base"), (F.col("turn") * 2.25).alias("lo"),
        (F.col("turn") * 2.25 + F.length("text") / 64.0).alias("hi"), "text",
    )


SEGMENTS = """segments AS (
  SELECT conv_id, turn, 'call_' || conv_id AS base, turn * 2.25::DOUBLE AS lo,
    turn * 2.25::DOUBLE + length(text) / 64.0::DOUBLE AS hi, text FROM conversations)"""


def timed_words(spark: SparkSession, folder: str) -> DataFrame:
    """Word times: words last by their length, and a pause follows a word that ends a clause."""
    turns = refs(spark, folder).select("audio_filepath", F.posexplode(F.split("text", " ", -1)).alias("pos", "word"))
    return turns.select(
        "audio_filepath",
        "pos",
        "word",
        (F.col("pos") * 1.0).alias("start"),
        (F.col("pos") + F.least(F.length("word"), F.lit(12)) / 16.0).alias("end"),
    )


TIMED_WORDS = """timed_words AS (
  SELECT audio_filepath, pos::INTEGER AS pos, word, pos::DOUBLE AS start,
    pos + least(length(word), 12) / 16.0::DOUBLE AS "end"
  FROM (SELECT audio_filepath, unnest(w) AS word, unnest(range(len(w))) AS pos
        FROM (SELECT audio_filepath, string_split(text, ' ') AS w FROM refs)))"""


def samples(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.concat(F.lit("vec_"), "vec_id").alias("key"), F.col("embedding").alias("samples"), F.lit(16000).alias("sampling_rate"), "vec_id", "label"
    )


def wav_files(spark: SparkSession, folder: str) -> DataFrame:
    """One WAV file per embedding; every label has a sampling rate of its own."""
    data = pcm_bytes(F.col("embedding"))
    rate = F.when(F.col("label") == 0, 16000).otherwise(8000 + F.col("label") * 1000)
    header = pcm_header(F.octet_length(data), rate, F.lit(1), F.lit(16))
    return table(spark, folder, "embeddings").select(
        F.concat(F.lit("/waves/vec"), "vec_id", F.lit(".wav")).alias("path"), F.concat(header, data).alias("content")
    )


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"
