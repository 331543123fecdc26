"""Keyword search in transcripts.

A list that a person has written down is passed as a Python list, and a list that is data as a table of any size. Each
text is matched where it stands, so no join with the list is needed: short lists become built-in ``contains`` tests,
others trees of their bytes inside an Arrow function.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import trie
from .dedupe import first_by, row_digest
from .ordering import top_per_group
from .word_parts import PART_WORDS, first_texts, found_words, write_parts

# Longest list tested with one expression per keyword; longer ones give the same rows by a tree.
_INLINE = 64


def _tree_hits(keywords: Sequence[str]):
    words = list(keywords)
    built: list = []

    @F.arrow_udf("array<int>")
    def hits(texts: pa.Array) -> pa.Array:
        if not built:
            listed = sorted({w for w in words if w})
            place = {w: k for k, w in enumerate(listed)}
            of: list[list[int]] = [[] for _ in listed]
            for at, word in enumerate(words):
                if word:
                    of[place[word]].append(at)
            built.extend([trie.build([w.encode() for w in listed]), of, [at for at, w in enumerate(words) if not w]])
        tree, of, always = built
        found: list[list[int]] = [list(always) for _ in range(len(texts))]
        for low, _, data, offsets in trie.blocks(texts):
            for row, word in zip(*(x.tolist() for x in trie.contained(tree, data, offsets))):
                found[low + row] += of[word]
        missing = texts.is_null().to_pylist()
        return pa.array([[] if gone else sorted(row) for row, gone in zip(found, missing)], pa.list_(pa.int32()))

    return hits


def keyword_hits(c: Column, keywords: Sequence[str]) -> Column:
    """Positions in the list of the keywords a text contains, case-sensitive.

    Every text contains the empty keyword; a null text contains none.
    """
    if len(keywords) <= _INLINE:
        tests = [F.when(F.contains(c, F.lit(word)), F.lit(at)) for at, word in enumerate(keywords)]
        return F.array_compact(F.array(*tests)) if tests else F.array().cast("array<int>")
    return _tree_hits(keywords)(c)


def keyword_matches(df: DataFrame, keywords: Sequence[str], col: str = "text") -> DataFrame:
    """One row per text and contained keyword, with the keyword's place in the list as ``kw_ord``."""
    names = F.array(*[F.lit(w) for w in keywords])
    matched = df.withColumn("kw_ord", F.explode(keyword_hits(F.col(col), keywords)))
    return matched.withColumn("keyword", F.element_at(names, F.col("kw_ord") + 1))


def _listed(keywords: DataFrame, word: str, order: str | None) -> DataFrame:
    """keyword and place, one row of each keyword: its least place, 0 without an ``order``; nulls are left out."""
    place = F.lit(0) if order is None else F.col(order)
    named = keywords.select(F.col(word).cast("string").alias("keyword"), place.cast("bigint").alias("place")).filter("keyword IS NOT NULL")
    return named.groupBy("keyword").agg(F.min("place").alias("place"))


def keyword_table_matches(df: DataFrame, keywords: DataFrame, word: str = "keyword", col: str = "text", order: str | None = None, per: int = PART_WORDS) -> DataFrame:
    """One row per text and contained keyword of a table of any size; null keywords are left out, repeated ones count once.

    With ``order``, a column of whole numbers, matches have the least one of their keyword as ``kw_ord``. The table is written in
    parts of about ``per`` keywords by tasks; one scan of the texts, which are not moved, loads the parts in turn.
    """
    listed = _listed(keywords, word, order).select(F.col("keyword").alias("word"), F.lit(None).cast("string").alias("note"), "place")
    hits = df.withColumn("_hit", F.explode(found_words(write_parts(listed, per))(F.col(col).cast("string"))))
    found = hits.withColumn("keyword", F.col("_hit.keyword"))
    return (found if order is None else found.withColumn("kw_ord", F.col("_hit.place"))).drop("_hit")


def select_by_keyword_table(
    df: DataFrame, keywords: DataFrame, cap: int = 1000, word: str = "keyword", kw_order: str = "kw_ord", col: str = "text", order: str = "row_id", per: int = PART_WORDS
) -> DataFrame:
    """``select_by_keywords`` for a table of any size, whose order of keywords is the column ``kw_order``; ties go by keyword.

    Matches carry a digest of their text and the row's ``order``, not the row, and meet by them; rows are joined to what is picked. A task
    reads its texts in order and lets out no more than ``cap`` matches of a keyword.
    """
    narrow = df.select(F.col(order).alias("_order"), row_digest(col).alias("_text"), F.col(col).alias("_col"))
    listed = _listed(keywords, word, kw_order).select(F.col("keyword").alias("word"), F.lit(None).cast("string").alias("note"), "place")
    kinds = narrow.select(F.lit("").alias("keyword"), F.lit(0).cast("bigint").alias("kw_ord"), "_order", "_text").schema
    in_order = narrow.withColumn("_col", F.col("_col").cast("string")).sortWithinPartitions("_order")
    matches = in_order.mapInArrow(first_texts(write_parts(listed, per), cap), kinds)
    capped = top_per_group(matches, ["keyword"], ["_order"], cap)
    picked = first_by(capped, "_text", ["kw_ord", "keyword", "_order"])
    own = [c for c in df.columns if c not in ("keyword", "kw_ord")]
    marked = df.select(*own, row_digest(col).alias("_text"), F.col(order).alias("_order"))
    found = marked.join(picked, ["_text", "_order"]).select(*own, "keyword", "kw_ord", "_text")
    # Rows that repeat text and order: one of them.
    return first_by(found, "_text", order).drop("_text")


def keyword_table_counts(
    df: DataFrame, keywords: DataFrame, cap: int = 1000, floor: int = 300, word: str = "keyword", col: str = "text", per: int = PART_WORDS
) -> DataFrame:
    """``keyword_counts`` for a table of any size: keyword, matches up to the cap, and whether they are too few."""
    hits = keyword_table_matches(df.select(col), keywords, word, col, None, per).groupBy("keyword").agg(F.count("*").alias("n"))
    n = F.least(F.coalesce("n", F.lit(0)), F.lit(cap))
    return _listed(keywords, word, None).join(hits, "keyword", "left").select("keyword", n.alias("n"), (n < floor).alias("small"))


def select_by_keywords(
    df: DataFrame, keywords: Sequence[str], cap: int = 1000, col: str = "text", order: str = "row_id"
) -> DataFrame:
    """The first ``cap`` matches of each keyword in input order, each text used once in keyword order.

    A match counts towards the cap even when an earlier keyword has used its text.
    """
    capped = top_per_group(keyword_matches(df, keywords, col), ["kw_ord"], [order], cap)
    return first_by(capped, col, ["kw_ord", order])


def keyword_counts(
    df: DataFrame, keywords: Sequence[str], cap: int = 1000, floor: int = 300, col: str = "text"
) -> DataFrame:
    """Matches per keyword up to the cap, keywords without any included, and whether they are too few."""
    hits = df.select(F.explode(keyword_hits(F.col(col), keywords)).alias("kw_ord"))
    found = hits.groupBy("kw_ord").agg(F.count("*").alias("n"))
    names = F.array(*[F.lit(w) for w in keywords])
    listed = df.sparkSession.range(1).select(F.posexplode(names).alias("kw_ord", "keyword"))
    n = F.least(F.coalesce("n", F.lit(0)), F.lit(cap))
    return listed.join(found, "kw_ord", "left").select("kw_ord", "keyword", n.alias("n"), (n < floor).alias("small"))
