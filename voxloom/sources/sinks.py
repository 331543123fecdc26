"""Writing manifests, reports, subtitles, step tables, shards and splits.

Every sink overwrites by default, so running a job again gives the same files instead of doubled ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.numbers import py_round
from ..operators.filters import to_manifest
from ..operators.sampling import shard


def write_manifest(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """JSON lines, non-ASCII kept; returns the number of lines, counted while writing."""
    seen = Observation()
    to_manifest(df).observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).json(path)
    return seen.get["n"]


def _percent(c: str):
    return F.format_string("%.2f", py_round(F.col(c), 2))


def write_score_report(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Scores as Parquet under ``table`` and as readable lines under ``text``, one folder per checkpoint."""
    scores.hint("rebalance", F.col("checkpoint")).write.mode(mode).partitionBy("checkpoint").parquet(f"{path}/table")
    line = F.concat_ws(
        "  |  ",
        F.col("audio_filepath"),
        *[
            F.concat(F.lit(f"{name}: "), _percent(c))
            for name, c in (("WER", "wer"), ("COR", "cor_pct"), ("DEL", "del_pct"), ("SUB", "sub_pct"), ("INS", "ins_pct"))
        ],
    )
    # Read back what was just written: the lines then cost no second alignment.
    table = scores.sparkSession.read.parquet(f"{path}/table")
    table.select("checkpoint", line.alias("value")).write.mode(mode).partitionBy("checkpoint").text(f"{path}/text")


def _one_line(c: str):
    return F.regexp_replace(F.col(c), r"[\r\n]+", " ")


def write_sanity_report(scored: DataFrame, path: str, threshold: float = 0.5, mode: str = "overwrite") -> None:
    """Lines with file, rate, reference and prediction: all under ``all``, those below the threshold under ``accepted``.

    ``scored`` holds audio_filepath, ref, hyp and error; ``parse_sanity_lines`` reads the lines back. Rows without a
    rate are left out.
    """
    rated = scored.filter("error IS NOT NULL").select("audio_filepath", "ref", "hyp", "error")
    rated.write.mode(mode).parquet(f"{path}/table")
    # Read back what was just written: the lines then cost no second comparison.
    table = scored.sparkSession.read.parquet(f"{path}/table")
    line = F.concat(
        F.lit("AUDIO FILENAME: "), "audio_filepath", F.lit(" |  WER RATE: "), F.col("error").cast("string"),
        F.lit(" |  gt text: "), _one_line("ref"), F.lit(" |  pred text: "), _one_line("hyp"),
    )
    table.select(line.alias("value")).write.mode(mode).text(f"{path}/all")
    table.filter(F.col("error") < threshold).select(line.alias("value")).write.mode(mode).text(f"{path}/accepted")


def write_averages(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The averages and, where given, the loan-word counts of each checkpoint as readable lines."""
    averages = [("COR", "avg_cor"), ("WER", "avg_wer"), ("INS", "avg_ins"), ("SUB", "avg_sub"), ("DEL", "avg_del")]
    parts = [F.concat(F.lit(f"AVERAGE {name}: "), _percent(c)) for name, c in averages]
    parts += [F.concat(F.lit(f"LOAN WORDS {c.upper()}: "), F.col(c).cast("string")) for c in ("tp", "fp", "fn") if c in report.columns]
    report.select("checkpoint", F.concat_ws("  |  ", "checkpoint", *parts).alias("value")).write.mode(mode).partitionBy("checkpoint").text(path)


def write_subtitles(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per video; the rebalance hint gathers a video's rows and still splits an outsized one."""
    df.hint("rebalance", F.col("video_id")).write.mode(mode).partitionBy("video_id").json(path)


def append_step_scores(df: DataFrame, step: int, path: str) -> None:
    """Add one step to the tracking table; writing a step again replaces it."""
    writer = df.withColumn("step", F.lit(step)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("step").parquet(path)


def write_shards(df: DataFrame, path: str, n: int, key: str = "audio_filepath", mode: str = "overwrite") -> None:
    shard(df, key, n).hint("rebalance", F.col("shard")).write.mode(mode).partitionBy("shard").json(path)


def write_splits(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Manifest rows under ``split=train`` and so on."""
    columns = [*to_manifest(df).columns, "split"]
    df.select(*columns).hint("rebalance", F.col("split")).write.mode(mode).partitionBy("split").json(path)
