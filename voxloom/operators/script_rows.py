"""Script conversion of manifest rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.script import MAX_TABLE, Pairs, convert_text, is_han_without, is_script, table_strings
from .word_parts import PART_WORDS, replaced_words, write_parts


def convert_script(df: DataFrame, col: str, table: Pairs) -> DataFrame:
    """Simplified texts in traditional script, others unchanged; ``converted`` marks the former."""
    if isinstance(table, DataFrame):
        table = list(zip(*table_strings(table)))
    text = F.col(col)
    hit = F.coalesce(is_script(text, table), F.lit(False))
    return df.withColumn("converted", hit).withColumn(col, F.when(F.col("converted"), convert_text(text, table)).otherwise(text))


def convert_phrases(df: DataFrame, col: str, phrases: DataFrame, per: int = PART_WORDS) -> DataFrame:
    """``convert_script`` over a table of phrases (simplified, traditional) of any size, single characters among them.

    Texts are read from left to right, and at each place the longest phrase of the table is replaced; what no phrase
    covers stays. A text is simplified if it has Han characters and none that only the traditional side of the table
    has. Null and empty phrases are left out, and of repeated ones the least replacement counts.
    """
    named = phrases.select(F.col("simplified").cast("string").alias("word"), F.col("traditional").cast("string").alias("note"))
    named = named.filter("length(word) > 0 AND note IS NOT NULL").groupBy("word").agg(F.min("note").alias("note"))

    def characters(c: str) -> DataFrame:
        return named.select(F.explode(F.split(c, "")).alias("ch")).filter("ch <> ''").distinct()

    # Characters, not phrases: there are no more of them than code points.
    only = [r["ch"] for r in characters("note").join(characters("word"), "ch", "left_anti").orderBy("ch").limit(MAX_TABLE + 1).collect()]
    if len(only) > MAX_TABLE:
        raise ValueError(f"phrases have more than {MAX_TABLE} characters")
    text = F.col(col)
    hit = F.coalesce(is_han_without(text, "".join(only)), F.lit(False))
    folder = write_parts(named.withColumn("place", F.lit(0)), per)
    swapped = replaced_words(folder)(F.when(F.col("converted"), F.col(col)))
    return df.withColumn("converted", hit).withColumn(col, F.when(F.col("converted"), swapped).otherwise(F.col(col)))
