"""Loan words: Latin-letter tokens in ground truth and predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import loan_tokens


def loan_words(df: DataFrame, tokens: str = "ref_words", keep: Sequence[str] = ()) -> DataFrame:
    """One row per loan-word occurrence, with the columns of ``keep``.

    A text without any gives one row with a null word, so that its checkpoint still gets a score.
    """
    return df.select(*keep, F.explode_outer(loan_tokens(F.col(tokens))).alias("word"))


def loan_word_totals(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count("word").alias("n_words"))


def _counted(truth: DataFrame, predicted: DataFrame, by: str) -> DataFrame:
    """(_truth, ``by``, word, n) of both sides, each read once; null words count nothing, but keep their checkpoint."""
    spoken = truth.filter("word IS NOT NULL").select(F.lit(None).cast(predicted.schema[by].dataType).alias(by), "word", F.lit(True).alias("_truth"))
    both = predicted.select(by, "word", F.lit(False).alias("_truth")).unionByName(spoken)
    return both.groupBy("_truth", by, "word").agg(F.count("word").alias("n"))


def loan_word_scores(
    truth: DataFrame, predicted: DataFrame, by: str = "checkpoint", only: Sequence[str] | None = None
) -> DataFrame:
    """True positives, false positives and false negatives per checkpoint from word occurrences.

    A predicted occurrence is right when its word is anywhere in the truth. A true occurrence is missed
    when the predictions of its word are used up one for one. The two are not symmetric, on purpose.
    ``only`` limits both sides to a keyword list.
    """
    if only is not None:
        wanted = F.when(F.col("word").isin(list(only)), F.col("word"))
        truth, predicted = truth.withColumn("word", wanted), predicted.withColumn("word", wanted)
    # A word has a row per checkpoint and one for the truth, so the window holds few rows however frequent it is.
    g = F.max(F.when(F.col("_truth"), F.col("n"))).over(Window.partitionBy("word"))
    met = _counted(truth, predicted, by).withColumn("g", g)
    known = ~F.col("_truth") & F.col("g").isNotNull()
    sums = met.groupBy("_truth", by).agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(~F.col("_truth") & F.col("g").isNull(), F.col("n"))), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(known, F.least("g", "n"))), F.lit(0)).alias("_covered"),
        F.sum(F.when(F.col("_truth"), F.col("n"))).alias("_total"),
    )
    # One row per checkpoint and one for the truth are left here.
    total = F.coalesce(F.max("_total").over(Window.partitionBy()), F.lit(0))
    return sums.withColumn("fn", total - F.col("_covered")).filter("NOT _truth").select(by, "tp", "fp", "fn")


def loan_word_pairs(
    truth: DataFrame, predicted: DataFrame, by: str | None = None, names: Sequence[str] | None = None
) -> DataFrame:
    """Occurrences of each word on both sides; words of one side only are included.

    With ``by`` there is a comparison for each of ``names``, the checkpoints, in one pass over both sides: words of the truth
    have a row for every checkpoint, others for those that predicted them.
    """
    if by is None:
        one = loan_word_pairs(truth, predicted.withColumn("_by", F.lit("")), "_by", [""])
        return one.drop("_by")
    if names is None:
        raise ValueError("name the checkpoints to compare")
    counted = _counted(truth, predicted, by).filter("word IS NOT NULL")
    per_word = counted.groupBy("word").agg(
        F.max(F.when(F.col("_truth"), F.col("n"))).alias("_g"),
        F.map_from_entries(F.collect_list(F.when(~F.col("_truth") & F.col(by).isNotNull(), F.struct(by, "n")))).alias("_heard"),
    )
    each = per_word.withColumn(by, F.explode(F.array(*[F.lit(n).cast(predicted.schema[by].dataType) for n in names])))
    rows = each.withColumn("heard", F.coalesce(F.try_element_at("_heard", F.col(by)), F.lit(0).cast("bigint")))
    kept = rows.filter("_g IS NOT NULL OR heard > 0")
    return kept.select(by, "word", F.coalesce("_g", F.lit(0).cast("bigint")).alias("in_truth"), "heard")
