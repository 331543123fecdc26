"""From raw documents to token ids in five stages; each is written as Parquet and read as the next one's documents."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import bpe, mixing, near_dedup, queries, secret_scan, toxicity
from voxloom.session import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on the labelled ones outside the held-out fifth, does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, ~queries.held_out(F.col("doc_id")))
    return toxicity.score(docs, model, docs.columns, out="_toxic").filter("_toxic < 0.5").select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the one with the smallest id, of each group of near copies by shingles of five words."""
    return near_dedup.one_of_each(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: some not at all, some up to three times."""
    return mixing.mixed_rows(docs).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document taken, and whether decoding them gives the text back."""
    ranks, pattern = queries.rank_file()
    # A digest goes along instead of the text, to compare what decoding gives.
    marked = docs.withColumn("_sha", F.sha2(F.coalesce("text", F.lit("")), 256))
    ids = bpe.encode_and_check(marked, ranks, pattern, ["doc_id", "lang", "source", "_sha"])
    return ids.select("doc_id", "lang", "source", "ids", F.size("ids").alias("n_tokens"), (F.col("decoded_sha256") == F.col("_sha")).alias("exact"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", one_of_each),
    ("secret_scan", hide_secrets),
    ("source_mix", mix_sources),
    ("byte_bpe", tokenize),
]

# The first stage trains a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each but the last returns is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
