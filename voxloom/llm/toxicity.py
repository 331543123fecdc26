"""Toxicity as a linear softmax over the average of subword embeddings, trained in numpy.

A text is a bag of subwords: for every word, with a blank in front and behind, its character n-grams, and the word
itself. Each is hashed to a row of an embedding table; the rows are averaged, and a linear layer with a softmax
turns the average into class probabilities. Embeddings and layer are trained together. A misspelt or inflected word
shares most n-grams with words seen in training, so it gets much of their score.

For scoring, embedding and layer fold into one number per bucket, so a text is scored by sums over its subwords,
computed for whole Arrow batches at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from hashlib import md5
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, carry, hash60
from .hashing import FACTORS, mix

BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
# Labelled rows of each class that training reads at most; see ``training_sample``.
MOST_PER_CLASS = 1_200
# Neutral subwords that every text has besides its own, so that one odd word does not decide a text of few words.
NEUTRAL = 100
_BLOCK_CHARS = 1 << 18


class Model(NamedTuple):
    """Difference of class scores per bucket, and the constant. A text scores sigmoid(mean of its buckets + bias)."""

    weights: np.ndarray
    bias: float


def text_chars(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, code points, row of each) for blocks of a bounded number of characters.

    Letters are lower-case and runs of ASCII blanks one blank; every row begins and ends with a blank.
    """
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    size = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 2
    ends = np.cumsum(size)
    low = 0
    while low < len(texts):
        start = ends[low] - size[low]
        high = max(low + 1, int(np.searchsorted(ends, start + _BLOCK_CHARS, "right")))
        joined = " " + "  ".join(texts.slice(low, high - low).to_pylist()) + " "
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        row = np.repeat(np.arange(low, high), size[low:high])
        blank = (chars == 32) | ((chars >= 9) & (chars <= 13))
        keep = np.ones(len(chars), bool)
        keep[1:] = ~(blank[1:] & blank[:-1] & (row[1:] == row[:-1]))
        yield low, high, np.where(blank, np.uint32(32), chars)[keep], row[keep]
        low = high


def subwords(chars: np.ndarray, row: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every subword: n-grams that do not cross a blank, then whole words."""
    value = mix(chars.astype(np.uint64) + np.uint64(1))
    blank = chars == 32
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    # crossed[i]: number of blanks before place i, so blanks inside an n-gram can be counted.
    crossed = np.concatenate([[0], np.cumsum(blank)])
    for n in GRAMS:
        m = len(chars) - n + 1
        if m <= 0:
            continue
        total = value[:m] * FACTORS[0]
        for j in range(1, n):
            total = total + value[j : j + m] * FACTORS[j]
        at = np.flatnonzero((crossed[n - 1 : n - 1 + m] == crossed[1 : 1 + m]) & (row[:m] == row[n - 1 : n - 1 + m]))
        yield row[at], (mix(total[at] + np.uint64(n)) >> shift).astype(np.int64)
    solid = np.flatnonzero(~blank)
    if len(solid):
        new = np.ones(len(solid), bool)
        new[1:] = (np.diff(solid) > 1) | (row[solid[1:]] != row[solid[:-1]])
        first = np.flatnonzero(new)
        place = np.arange(len(solid)) - np.repeat(first, np.diff(np.append(first, len(solid))))
        whole = np.add.reduceat(mix(value[solid] + place.astype(np.uint64) * FACTORS[60]), first)
        yield row[solid[first]], (mix(whole ^ FACTORS[61]) >> shift).astype(np.int64)


def training_sample(
    df: DataFrame, labels: DataFrame, usable: Column, key: str, text: str, label: str, most: int = MOST_PER_CLASS
) -> tuple[DataFrame, dict[int, int]]:
    """Up to ``most`` labelled rows of either class, in an order drawn by hash, and how many rows each class has.

    A key on several rows counts once. This bounds what training reads, not what is scored. Rows with a null label, or whose text is missing, are
    not used. ``usable`` is a condition on the labelled key.
    """
    known = labels.filter(usable & F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(label).alias("_label"))
    counts = {int(r[0]): int(r[1]) for r in known.groupBy("_label").count().collect()}
    draw = hash60(F.col("_key").cast("string"))
    picked = None
    for value in (0, 1):
        part = known.filter(F.col("_label") == value).orderBy(draw, "_key").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    rows = df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    met = rows.filter("_text IS NOT NULL").join(F.broadcast(picked), "_key")
    # One text of each key, that of the least digest, so that a key on many rows is no larger than others.
    one = met.groupBy("_key", "_label").agg(F.min(F.struct(F.sha2("_text", 256).alias("_digest"), "_text")).alias("_one"))
    return one.select("_one._text", "_label"), counts


def text_bags(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, shares) of each text; the shares and that of the neutral subwords add up to one."""
    for low, high, chars, row in text_chars(texts):
        parts = list(subwords(chars, row))
        rows, buckets = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 2
        pairs, counts = np.unique((rows - low) * BUCKETS + buckets, return_counts=True)
        cuts = np.searchsorted(pairs, np.arange(high - low + 1) * BUCKETS)
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield (pairs[a:b] % BUCKETS).astype(np.int32), (counts[a:b] / (counts[a:b].sum() + NEUTRAL)).astype(np.float32)


class Bags(NamedTuple):
    """Texts as bags, one after the other in flat arrays: text k has places ``cuts[k]`` to ``cuts[k + 1]``."""

    labels: np.ndarray
    cuts: np.ndarray
    buckets: np.ndarray
    shares: np.ndarray


def flat_bags(labels: Sequence[int], bags: Sequence[tuple[np.ndarray, np.ndarray]]) -> Bags:
    cuts = np.concatenate([[0], np.cumsum([len(b) for b, _ in bags], dtype=np.int64)])
    none = (np.zeros(0, np.int32), np.zeros(0, np.float32))
    return Bags(np.array(labels, np.int64), cuts, *(np.concatenate(x) for x in zip(none, *bags)))


def _bags(sample: DataFrame) -> Bags:
    """The sampled texts, no more than two numbers per bucket and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Steps between ascending buckets and shares of half precision pack to a few bytes a place.
            bags = [
                zlib.compress(np.diff(b, prepend=np.int32(0)).astype(np.int32).tobytes() + (x * 1024).astype(np.float16).tobytes(), 6)
                for b, x in text_bags(batch.column(0))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), pa.array(bags, pa.binary())], ["label", "bag"])

    found = [(r[0], bytes(r[1])) for r in sample.mapInArrow(run, "label int, bag binary").collect()]
    # The order of the rows must not depend on the order of tasks, since training visits them in turn.
    found.sort(key=lambda r: (md5(r[1]).digest(), r[0]))

    def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
        raw = zlib.decompress(packed)
        n = len(raw) // 6
        steps, shares = np.frombuffer(raw, np.int32, n), np.frombuffer(raw, np.float16, n, 4 * n)
        return np.cumsum(steps, dtype=np.int32), shares.astype(np.float32) / 1024

    return flat_bags([y for y, _ in found], [unpack(packed) for _, packed in found])


def train(
    bags: Bags,
    counts: dict[int, int],
    width: int = 4,
    passes: int = 15,
    batch: int = 64,
    rate: float = 0.05,
    decay: float = 0.002,
    scale: float = 300.0,
    seed: int = 0,
) -> Model:
    """Embeddings and softmax layer, trained together by Adam on mini-batches of cross entropy.

    ``scale`` multiplies the averages, which are small where a few words of many decide. Buckets met in fewer than
    three texts get no embedding. If the classes were sampled unequally, the constant is set right at the end.
    """
    label = bags.labels
    taken = [int((label == y).sum()) for y in (0, 1)]
    prior = np.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5))
    if not taken[0] or not taken[1]:
        return Model(np.zeros(BUCKETS, np.float32), float(prior))
    # A bucket occurs once in a bag, so its count is the number of its texts.
    used = np.flatnonzero(np.bincount(bags.buckets, minlength=BUCKETS) >= min(3, len(label)))
    number = np.full(BUCKETS, -1, np.int32)
    number[used] = np.arange(len(used), dtype=np.int32)
    kept = number[bags.buckets] >= 0
    cuts = np.concatenate([[0], np.cumsum(kept)])[bags.cuts]
    seen = number[bags.buckets[kept]]
    share = bags.shares[kept] * np.float32(scale)
    del bags, kept
    draw = np.random.Generator(np.random.PCG64(seed))
    table = draw.normal(0, 0.01, (width, len(used))).astype(np.float32)
    layer = draw.normal(0, 0.5, (width, 2)).astype(np.float32)
    constant = np.zeros(2, np.float32)
    values = [table, layer, constant]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step, steps = 0, passes * -(-len(label) // batch)
    for _ in range(passes):
        order = draw.permutation(len(label))
        for low in range(0, len(label), batch):
            rows = order[low : low + batch]
            at = np.concatenate([seen[cuts[r] : cuts[r + 1]] for r in rows])
            x = np.concatenate([share[cuts[r] : cuts[r + 1]] for r in rows])
            row = np.repeat(np.arange(len(rows)), cuts[rows + 1] - cuts[rows])
            mean = np.stack([np.bincount(row, x * table[d, at], len(rows)) for d in range(width)], 1)
            score = mean @ layer + constant
            p = np.exp(score - score.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), label[rows]] -= 1
            p /= len(rows)
            back = (p @ layer.T).astype(np.float32)
            grads = [
                np.stack([np.bincount(at, x * back[row, d], len(used)) for d in range(width)]) + decay * table,
                mean.T @ p,
                p.sum(0),
            ]
            step += 1
            now = rate * (1 - (step - 1) / steps) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for v, g, m, s in zip(values, grads, first, second):
                g = g.astype(np.float32)
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= (now * m / (np.sqrt(s) + 1e-6)).astype(np.float32)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = scale * ((layer[:, 1] - layer[:, 0]) @ table)
    sampled = np.log(taken[1] / taken[0])
    return Model(weights, float(constant[1] - constant[0] + prior - sampled))


def fit(df: DataFrame, labels: DataFrame, usable: Column, key: str = "doc_id", text: str = "text", label: str = "toxic", **options) -> Model:
    """A model from the labelled rows of ``df`` whose key is ``usable``. Without rows of both classes it is constant."""
    bound_batches(df.sparkSession)
    sample, counts = training_sample(df, labels, usable, key, text, label)
    return train(_bags(sample), counts, **options)


def score(df: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), text: str = "text", out: str = "score") -> DataFrame:
    """The columns ``keep`` of every row with the probability that its whole text is toxic as ``out``.

    Null and empty texts get the score of no evidence. The model, a megabyte, is sent to every worker. A column of ``keep``
    named like ``out`` is replaced.
    """
    keep = [c for c in keep if c != out]
    sent = df.sparkSession.sparkContext.broadcast(model)
    texts, at = carry(df, keep, text)
    schema = T.StructType([*df.select(*keep).schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value
        weights = weights.astype(np.float64)
        for batch in batches:
            found = np.zeros(batch.num_rows)
            for low, high, chars, row in text_chars(batch.column(at)):
                total, many = np.zeros(high - low), np.zeros(high - low)
                for rows, buckets in subwords(chars, row):
                    total += np.bincount(rows - low, weights[buckets], high - low)
                    many += np.bincount(rows - low, minlength=high - low)
                logit = np.clip(total / (many + NEUTRAL) + bias, -30, 30)
                found[low:high] = 1 / (1 + np.exp(-logit))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(found)], [*keep, out])

    return texts.mapInArrow(run, schema)
