"""Splitting run-together Latin text into words, with word counts learned from a corpus.

Words and pairs are written by tasks as tables in parts. A task cuts a stretch of texts into runs, splits the distinct tokens of the stretch
together and puts the texts together again, so no run, token or substring is a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log10

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import runs, splits
from ..functions.splits import MAX_WORD
from ..session import settle, spread
from . import split_tables

# Letters of the tokens that are split together.
_LETTERS = 1 << 17
# Bytes of the texts that are cut, or counted, together.
_TEXT = 1 << 23


def word_counts(df: DataFrame, col: str = "text") -> DataFrame:
    """Occurrences of each Latin word in well-spaced text."""

    def count(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        found, _ = runs.words(texts)
        coded = found.dictionary_encode()
        return coded.dictionary, np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))

    return _counted(df, col, count, "word")


def word_pair_counts(df: DataFrame, col: str = "text") -> DataFrame:
    """Occurrences of each pair of neighbouring Latin words, as ``first second``."""

    def count(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        found, of_text = runs.words(texts)
        coded = found.dictionary_encode()
        word = coded.indices.to_numpy().astype(np.int64)
        near = np.flatnonzero(of_text[1:] == of_text[:-1])
        key, many = np.unique(word[near] << 32 | word[near + 1], return_counts=True)
        first, second = (coded.dictionary.take(pa.array(k)) for k in (key >> 32, key & 0xFFFFFFFF))
        return pc.binary_join_element_wise(first, second, pa.scalar(" ", pa.large_string())), many

    return _counted(df, col, count, "pair")


def _counted(df: DataFrame, col: str, count, name: str) -> DataFrame:
    """(name, n): what ``count`` finds in stretches of texts, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for low, high in _stretches(_offsets(texts), _TEXT):
                found, many = count(texts.slice(low, high - low))
                yield pa.RecordBatch.from_arrays([found.cast(pa.string()), pa.array(many.astype(np.int64))], [name, "n"])

    texts = spread(df.select(F.col(col).cast("string")))
    return texts.mapInArrow(run, f"{name} string, n long").groupBy(name).agg(F.sum("n").alias("n"))


def best_split(token: str, counts: dict[str, int], pairs: dict[str, int], total: float) -> list[str]:
    """Most likely words of one token: known words by count, unknown ones ever less likely with length,
    a known pair by its count given the first word."""

    known = {word: log10(n / total) for word, n in counts.items()}
    unknown = [1.0 - log10(total) - size for size in range(MAX_WORD + 1)]
    given: dict[str, dict[str, float]] = {}
    for pair, n in pairs.items():
        first, word = pair.split(" ")
        if first in known:
            given.setdefault(word, {})[first] = log10(n / total) - known[first]

    # cells[end][size - 1] = (score of the best split whose last word has that size, size of the word before
    # it); top is the best entry of a cell with its size.
    cells: list[list[tuple[float, int]]] = [[]]
    top = [(0.0, 0)]
    for end in range(1, len(token) + 1):
        cell = []
        for size in range(1, min(MAX_WORD, end) + 1):
            start = end - size
            word = token[start:end]
            score, before = top[start]
            alone, after = known.get(word, unknown[size]), given.get(word)
            if after is None or not start:
                cell.append((score + alone, before))
            else:
                cell.append(
                    max(
                        (so_far + after.get(token[start - k : start], alone), k)
                        for k, (so_far, _) in enumerate(cells[start], 1)
                    )
                )
        cells.append(cell)
        top.append(max((score, size) for size, (score, _) in enumerate(cell, 1)))
    out, end, size = [], len(token), top[-1][1]
    while end:
        out.append(token[end - size : end])
        end, size = end - size, cells[end][size - 1][1]
    return out[::-1]


def _offsets(texts: pa.Array) -> np.ndarray:
    """Where texts begin, and the last one ends."""
    return np.append(0, np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)))


def _stretches(offsets: np.ndarray, letters: int) -> Iterator[tuple[int, int]]:
    """Rows of about so many letters, a longer text alone."""
    low = 0
    while low < len(offsets) - 1:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + letters, "right")) - 1)
        yield low, high
        low = high


def _splitter(counts: DataFrame, pairs: DataFrame | None):
    """A function for tasks: the words of distinct tokens of a-z and 0-9. The tables are written to the shared folder at once."""
    # Words with other letters lie in no token, but count.
    counts = settle(counts.filter(F.length("word") <= MAX_WORD))
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    listed = counts.filter(F.col("word").rlike("^[a-z0-9]+\\z")).select("word", F.col("n").cast("long"))
    words = split_tables.write_words(listed.groupBy("word").agg(F.max("n").alias("n")))
    find_pairs = None
    if pairs is not None:
        pairs = settle(pairs.select("pair", "n"))
        near = split_tables.write_pairs(pairs, words)
        if not near.whole:
            # A second word need not have been counted itself.
            others = split_tables.second_words(pairs).withColumn("n", F.lit(None).cast("long"))
            words = split_tables.write_words(listed.unionByName(others).groupBy("word").agg(F.max("n").alias("n")))
            near = split_tables.write_pairs(pairs, words)
        find_pairs = split_tables.pair_finder(near)
    may, find_words = split_tables.word_filter(words), split_tables.word_finder(words)

    def split(tokens: pa.Array) -> pa.Array:
        if not len(tokens):
            return pa.array([], pa.large_string())
        # Texts of like length are split in fewer steps.
        size = np.diff(_offsets(tokens))
        order = np.argsort(-size, kind="stable")
        tokens = tokens.take(pa.array(order)).cast(pa.large_string())
        ends = np.frombuffer(tokens.buffers()[1], np.int64)[tokens.offset : tokens.offset + len(tokens) + 1]
        letters = np.frombuffer(tokens.buffers()[2] or b"", np.uint8)
        made = []
        for low, high in _stretches(ends, _LETTERS):
            data, offsets = letters[ends[low] : ends[high]], ends[low : high + 1] - ends[low]
            texts = splits.laid_out(data, offsets)
            cut = splits.split(texts, splits.known_words(texts, may, find_words), total, find_pairs)
            made.append(runs.large_strings(*splits.spaced(data, offsets, cut)))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return pa.concat_arrays(made).take(pa.array(back))

    return split


def token_splits(tokens: DataFrame, counts: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """(token, words) for a frame of distinct ``token`` of a-z and 0-9; ``counts`` is (word, n), ``pairs`` is (pair, n).

    The tables are written to the shared folder at once, the tokens are split when the result is read.
    """
    split = _splitter(counts, pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in _stretches(_offsets(batch.column(0)), _TEXT):
                part = batch.column(0).slice(low, high - low)
                yield pa.RecordBatch.from_arrays([part, split(part).cast(pa.string())], ["token", "words"])

    return spread(tokens.select("token")).mapInArrow(run, "token string, words string")


def _han(spark: SparkSession) -> np.ndarray:
    """Code points of the session's class of Han characters, as (first, last); a few dozen ranges."""
    ids = spark.range(0x2E80, 0x40000, 1, 4).filter("id NOT BETWEEN 55296 AND 57343")
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    found = np.sort(np.array([r[0] for r in ids.filter(char.rlike(r"\p{IsHan}")).collect()], np.int64))
    edge = np.flatnonzero(np.diff(found) > 1)
    return np.stack([found[np.append(0, edge + 1)], found[np.append(edge, len(found) - 1)]], 1)


def segment_latin(
    df: DataFrame, counts: DataFrame, pairs: DataFrame | None = None, key: str = "row_id", col: str = "text"
) -> DataFrame:
    """Respace transcripts: blanks out, scripts spaced, Latin runs split into lower-case words.

    The result starts with a blank. A text that is one run is only split when it begins with a lower-case
    letter; runs without a letter pass through. A null text stays null. Rows that share a key get one text, of the runs of all of them by
    their place; a row without a key has none.
    """
    split, ranges = _splitter(counts, pairs), _han(df.sparkSession)
    shared = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").select(key)
    alone = shared.isEmpty()
    rest = [c for c in df.columns if c not in (key, col)]

    def pieces(texts: pa.Array, is_han: np.ndarray) -> pa.Array:
        cut = runs.runs(texts, is_han)
        words = split(cut.tokens).take(pa.array(cut.token, mask=cut.token < 0))
        whole = pc.coalesce(words, cut.whole).cast(pa.string())
        offsets = np.append(0, np.cumsum(np.bincount(cut.of_text, minlength=len(texts))))
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_han = np.zeros(1 << 21, bool)
        for first, last in ranges.tolist():
            is_han[first : last + 1] = True
        for batch in batches:
            for low, high in _stretches(_offsets(batch.column(0)), _TEXT):
                part = batch.slice(low, high - low)
                lists, null = pieces(part.column(0), is_han), part.column(0).is_null()
                if alone:
                    lists = pc.binary_join_element_wise("", pc.binary_join(lists, " "), " ")
                made = pc.if_else(null, pa.scalar(None, lists.type), lists)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], made], names)

    names = [key, *rest, col]
    # Splitting costs some microseconds a letter, so tasks are more than the bytes ask for.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = df.select(F.col(col).cast("string").alias("_text"), key, *rest).repartition(parts)
    fields = [df.select(key, *rest).schema[n] for n in range(len(names) - 1)]
    cut = texts.mapInArrow(run, T.StructType([*fields, T.StructField(col, T.StringType() if alone else T.ArrayType(T.StringType()))]))
    if alone:
        return cut.withColumn(col, F.when(F.col(key).isNotNull(), F.col(col)))
    cut = settle(cut)
    both = cut.join(shared, key, "left_semi").select(key, F.posexplode(col).alias("pos", "words"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "words"))), lambda p: p["words"]), " ")
    merged = both.groupBy(key).agg(F.concat(F.lit(" "), text).alias("_merged"))
    joined = cut.join(merged, key, "left")
    own = F.when(F.col(key).isNotNull(), F.concat(F.lit(" "), F.array_join(col, " ")))
    return joined.select(key, *rest, F.coalesce("_merged", own).alias(col))
