"""Pairing transcripts with predictions, per-file rates, and scores per checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import py_round
from ..functions.paths import natural_key
from ..functions.text import normalize_basic, space_scripts, strip_punct, tokenize_mixed, words
from ..session import spread
from .alignment import align, cer, char_distance
from .filters import reason_if


def scoring_words(c: Column) -> Column:
    """Punctuation out, scripts spaced, then mixed-script tokens: the scoring form of a transcript."""
    return tokenize_mixed(space_scripts(strip_punct(c)))


def plain_words(c: Column) -> Column:
    """Words of the normalised text, as the sanity check compares them."""
    return words(normalize_basic(c))


def pair(refs: DataFrame, predictions: DataFrame, key: str = "audio_filepath") -> DataFrame:
    """Each reference row with each checkpoint's prediction for its file.

    Predictions hold one row per checkpoint and file. Both sides meet in a plain equi-join, which adaptive
    execution splits when a file has very many rows.
    """
    return refs.withColumnRenamed("text", "ref").join(predictions, key)


def pending_work(
    checkpoints: Sequence[str], refs: DataFrame, predictions: DataFrame, key: str = "audio_filepath"
) -> DataFrame:
    """(checkpoint, file) still to transcribe: every combination without a prediction.

    Finished checkpoints are gathered per file, so only missing combinations are ever written out.
    """
    names = list(checkpoints)
    done = (
        predictions.filter(F.col("checkpoint").isin(names))
        .groupBy(key)
        .agg(F.collect_set("checkpoint").alias("_done"))
    )
    wanted = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    todo = F.array_except(wanted, F.coalesce("_done", F.array().cast("array<string>")))
    return refs.select(key).distinct().join(done, key, "left").select(F.explode(todo).alias("checkpoint"), key)


def rates(df: DataFrame) -> DataFrame:
    """Word error rate and shares of the reference words in percent; null for an empty reference.

    ``wer`` is rounded to three decimals per file before anything is averaged, and is a percentage.
    """

    def share(c: str) -> Column:
        return F.try_divide(F.col(c).cast("double") * 1.0, F.col("ref_len")) * 100.0

    errors = F.try_divide((F.col("sub") + F.col("ins") + F.col("del")).cast("double"), F.col("ref_len"))
    return df.select(
        *df.columns,
        (py_round(errors, 3) * 100.0).alias("wer"),
        share("cor").alias("cor_pct"),
        share("sub").alias("sub_pct"),
        share("ins").alias("ins_pct"),
        share("del").alias("del_pct"),
    )


def score_words(pairs: DataFrame, ref: str = "ref_words", hyp: str = "hyp_words") -> DataFrame:
    """Counts and rates per pair; rows with an empty reference carry reason ``empty_ref`` and null rates."""
    scored = rates(align(pairs, ref, hyp))
    return scored.withColumn("reason", reason_if(F.col("ref_len") < 1, "empty_ref"))


MACRO = {"cor": "cor_pct", "wer": "wer", "ins": "ins_pct", "sub": "sub_pct", "del": "del_pct"}


def macro_scores(scores: DataFrame, by: str | Sequence[str] = "checkpoint") -> DataFrame:
    """Averages of the per-file percentages: every file weighs the same, whatever its length."""
    by = [by] if isinstance(by, str) else list(by)
    averages = [F.avg(c).alias(f"avg_{name}") for name, c in MACRO.items()]
    return scores.groupBy(*by).agg(F.count("wer").alias("n_files"), *averages)


def pair_cer(pairs: DataFrame, ref: str = "ref", hyp: str = "hyp", below: float | None = None) -> DataFrame:
    """Add ``cer`` to each pair; with ``below``, rates that are not below it may be null, which ``below_rate`` refuses like them."""
    return spread(pairs).withColumn("cer", cer(F.col(ref), F.col(hyp), below))


def micro_cer(pairs: DataFrame, by: str | Sequence[str] = "checkpoint", ref: str = "ref", hyp: str = "hyp") -> DataFrame:
    """Character errors over reference characters, all pairs taken together."""
    by = [by] if isinstance(by, str) else list(by)
    counted = spread(pairs.select(*by, ref, hyp)).select(
        *by, char_distance(F.col(ref), F.col(hyp)).alias("_errors"), F.length(ref).alias("_chars")
    )
    return counted.groupBy(*by).agg(F.try_divide(F.sum("_errors"), F.sum("_chars")).alias("cer"))


def best_checkpoint(
    macro: DataFrame, cor: str | None = "avg_cor", wer: str | None = "avg_wer", cer: str | None = None
) -> DataFrame:
    """Checkpoints with the highest share of correct words and the lowest error rates.

    Equal scores go to the checkpoint that comes first in natural order.
    """
    name = natural_key(F.col("checkpoint"))

    def first(score: Column, alias: str) -> Column:
        return F.min_by("checkpoint", F.struct(score, name)).alias(alias)

    picks = []
    if cor is not None:
        picks.append(first(-F.col(cor), "best_by_cor"))
    if wer is not None:
        picks.append(first(F.col(wer), "best_by_wer"))
    if cer is not None:
        picks.append(first(F.col(cer), "best_by_cer"))
    return macro.agg(*picks)
