"""Which checkpoint is best: score every prediction, average per checkpoint, rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import natural_key
from ..session import settle, spread
from ..operators.loanwords import loan_word_scores, loan_words
from ..operators.scoring import macro_scores, pair, score_words, scoring_words


def score_checkpoints(refs: DataFrame, predictions: DataFrame) -> DataFrame:
    """Counts and rates per (checkpoint, file).

    Raw texts go through the join and are spread over all tasks; cleaning, cutting into words and aligning
    then share one stage.
    """
    pairs = spread(pair(refs.select("audio_filepath", "text"), predictions.select("checkpoint", "audio_filepath", "hyp")))
    worded = pairs.select(
        "checkpoint",
        "audio_filepath",
        scoring_words(F.col("ref")).alias("ref_words"),
        scoring_words(F.col("hyp")).alias("hyp_words"),
    )
    return score_words(worded).drop("ref_words", "hyp_words")


def _clean(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """The columns ``keep`` and the scoring words of ``text`` with blanks between, cleaned once and written."""
    return settle(spread(df.select(*keep, text)).select(*keep, F.array_join(scoring_words(F.col(text)), " ").alias("text")))


def _cut(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def checkpoint_report(refs: DataFrame, predictions: DataFrame) -> DataFrame:
    """Average rates and loan-word counts per checkpoint, marking the two picks.

    Every reference and prediction is cleaned once, however many checkpoints meet it; alignment and loan words both read the
    cleaned texts.
    """
    spoken = _clean(refs, "text", "audio_filepath")
    heard = _clean(predictions, "hyp", "checkpoint", "audio_filepath")
    pairs = spread(pair(spoken, heard.withColumnRenamed("text", "hyp")))
    worded = pairs.select("checkpoint", _cut(F.col("ref")).alias("ref_words"), _cut(F.col("hyp")).alias("hyp_words"))
    macro = macro_scores(score_words(worded))
    truth = loan_words(spoken.select(_cut(F.col("text")).alias("ref_words")))
    said = loan_words(heard.select("checkpoint", _cut(F.col("text")).alias("hyp_words")), "hyp_words", ["checkpoint"])
    # One row per checkpoint is left here, so ranking them in one task is nothing.
    name = natural_key(F.col("checkpoint"))
    by_cor, by_wer = Window.orderBy(F.desc("avg_cor"), name), Window.orderBy("avg_wer", name)
    ranked = macro.select(
        "*",
        (F.row_number().over(by_cor) == 1).alias("is_best_cor"),
        (F.row_number().over(by_wer) == 1).alias("is_best_wer"),
    )
    return ranked.join(loan_word_scores(truth, said), "checkpoint", "left")
