"""Passages repeated across documents, by suffix trees over words that are partitioned by prefix.

A suffix of a document begins at a word. Suffixes with the same first words share a prefix; prefixes, as long as
the data ask for, part all suffixes into groups that fit in memory, and each group is a subtree. Only nodes that two documents share are
built further, level by level: first at a depth of five words, for a sample of suffixes that meets every window of ``window`` words,
then at the depth of a window for the suffixes whose sample lives on. The nodes at that depth are
the repeats; a maximal repeat is a run of words covered by them.

Prefixes are compared by hash, of 64 bits in the first level, which only selects, and 96 bits in the second. A
group is a range of hash prefixes, and the number of their bits follows the size of the input. Before suffixes are sent to
their group, each task merges the suffixes of the same node, so a passage that every document holds reaches its
group once per task.

Texts cross the network once, partitioned by document; both later passes read that shuffle.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches
from .hashing import FACTORS, find_words, hash_pieces, mix, sequences, text_blocks, window_minimum

DEPTH = 5
# Suffixes a task merges before it sends them on, and bytes a group is meant to hold.
_FLUSH, _GROUP = 1_000_000, 32 << 20
_SUFFIX = np.dtype([("h", "<u8"), ("c", "<u4"), ("d", "<i8")])
#: In place of a document: at least two documents have this node.
_MANY = np.iinfo(np.int64).min
_ROUTED = "bucket int, settled boolean, data binary"


def _bits(df: DataFrame) -> int:
    """Length of the hash prefixes that part about the input's size into groups."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(8, min(30, (size // (_GROUP // 8)).bit_length()))


_HEAD = "<qBBQq"


def _narrow(x: np.ndarray) -> tuple[int, bytes]:
    """Unsigned numbers in as few bytes each as the largest needs."""
    width = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
    return width, np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _widen(raw: memoryview, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, n * width).reshape(n, width)
    return out.view("<u8").ravel()


def _pack(s: np.ndarray, checked: bool) -> bytes:
    """Suffixes in order of hash: steps between hashes, documents from the smallest on, and in the second level checks."""
    real = s["d"] != _MANY
    base = int(s["d"][real].min()) if real.any() else 0
    place = np.where(real, (s["d"] - base).view(np.uint64) + np.uint64(1), np.uint64(0))
    (w, steps), (v, places) = _narrow(np.diff(s["h"])), _narrow(place)
    head = struct.pack(_HEAD, len(s), w, v, int(s["h"][0]), base)
    return head + steps + places + (np.ascontiguousarray(s["c"]).tobytes() if checked else b"")


def _unpack(parts: list[bytes], checked: bool) -> np.ndarray:
    out = []
    for part in parts:
        n, w, v, first, base = struct.unpack_from(_HEAD, part)
        raw = memoryview(part)[struct.calcsize(_HEAD) :]
        s = np.zeros(n, _SUFFIX)
        s["h"] = np.cumsum(np.concatenate([np.array([first], np.uint64), _widen(raw, n - 1, w)]), dtype=np.uint64)
        place = _widen(raw[(n - 1) * w :], n, v)
        s["d"] = np.where(place == 0, _MANY, (place - np.uint64(1)).view(np.int64) + base)
        if checked:
            s["c"] = np.frombuffer(raw[(n - 1) * w + n * v :], "<u4", n)
        out.append(s)
    return np.concatenate(out)


def _settled(s: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Suffixes by group of documents: the group's number, and its documents and hashes one after the other."""
    if len(s):
        group = (mix(np.ascontiguousarray(s["d"]).view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int32)
        order = np.argsort(group, kind="stable")
        s, group = s[order], group[order]
        cuts = np.flatnonzero(np.diff(group)) + 1
        low, high = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(s)]])
        d, h = np.ascontiguousarray(s["d"]), np.ascontiguousarray(s["h"])
        yield group[low], [d[a:b].tobytes() + h[a:b].tobytes() for a, b in zip(low, high)]


def _block_suffixes(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(row, sample hash, hash, check, first word) per window of a block, and the row of each word.

    The sample of a window is the least hash of its prefixes of ``DEPTH`` words; equal windows have equal samples.
    """
    starts, ends, row = find_words(data, offsets)
    words = hash_pieces(data, starts, ends)
    whole, at = sequences(words, row, window)
    if not len(at):
        none = np.zeros(0, np.uint64)
        return at, none, none, none.astype(np.uint32), at, row
    depth = min(DEPTH, window)
    short, short_at = sequences(words, row, depth)
    number = np.full(len(words), -1, np.int64)
    number[short_at] = np.arange(len(short_at))
    least = window_minimum(short, window - depth + 1)
    sample = short[least[number[at]]]
    check = np.zeros(len(at), np.uint64)
    for j in range(window):
        check += words[at + j] * FACTORS[(20 + j) % len(FACTORS)]
    return row[at], sample, whole, (mix(check) >> np.uint64(32)).astype(np.uint32), at, row


def _route(rows: list[np.ndarray], bits: int, first_only: bool) -> Iterator[pa.RecordBatch]:
    """Merge the suffixes of each node, and send one on per node, by group; and what is settled already, by document.

    With ``first_only`` a node goes on with its smallest document, and the others are settled: theirs is a repeat.
    Otherwise a node of two documents goes on as such, and both are settled; a document alone goes on with its number.
    """
    if not any(map(len, rows)):
        return
    s = np.concatenate(rows)
    s = s[np.lexsort((s["d"], s["c"], s["h"]))]
    fresh = np.ones(len(s), bool)
    fresh[1:] = (s["h"][1:] != s["h"][:-1]) | (s["c"][1:] != s["c"][:-1]) | (s["d"][1:] != s["d"][:-1])
    s = s[fresh]
    head = np.ones(len(s), bool)
    head[1:] = (s["h"][1:] != s["h"][:-1]) | (s["c"][1:] != s["c"][:-1])
    group = np.cumsum(head) - 1
    sent = s[head].copy()
    if first_only:
        settled = s[~head]
    else:
        shared = np.bincount(group) > 1
        sent["d"][shared] = _MANY
        settled = s[shared[group]]
    bucket = (sent["h"] >> np.uint64(64 - bits)).astype(np.int32)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    low, high = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(sent)]])
    packed = [_pack(sent[a:b], first_only) for a, b in zip(low, high)]
    yield _routed(bucket[low], False, packed)
    for group, packed in _settled(settled, bits):
        yield _routed(group, True, packed)


def _routed(bucket: np.ndarray, settled: bool, packed: list[bytes]) -> pa.RecordBatch:
    columns = [pa.array(bucket), pa.array(np.full(len(bucket), settled)), pa.array(packed, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "settled", "data"])


def _gather(routed: DataFrame, bits: int, first_only: bool) -> DataFrame:
    """(doc, nodes): packed hashes of the nodes of each document that another, or a smaller, document has too.

    What a group of prefixes finds goes on by groups of documents, so its rows do not multiply with the number of tasks.
    """

    def resolve(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        s = _unpack(parts, first_only)
        s = s[np.lexsort((s["d"], s["c"], s["h"]))]
        head = np.ones(len(s), bool)
        head[1:] = (s["h"][1:] != s["h"][:-1]) | (s["c"][1:] != s["c"][:-1])
        first = np.flatnonzero(head)
        least = s["d"][first][np.cumsum(head) - 1]
        if first_only:
            found = s[s["d"] > least]
        else:
            most = s["d"][np.append(first[1:], len(s)) - 1][np.cumsum(head) - 1]
            found = s[(least < most) & (s["d"] != _MANY)]
        for group, packed in _settled(found, bits):
            yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(packed, pa.binary())], ["bucket", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, now = [], 0, None
        for batch in batches:
            buckets, done = batch.column(0), batch.column(1)
            if done.true_count:
                yield pa.RecordBatch.from_arrays([buckets.filter(done), batch.column(2).filter(done)], ["bucket", "data"])
            buckets = buckets.to_numpy()
            for k in np.flatnonzero(~done.to_numpy(zero_copy_only=False)):
                # Groups are resolved together until they fill the memory meant for one.
                if buckets[k] != now and size >= _GROUP:
                    yield from resolve(held)
                    held, size = [], 0
                now = buckets[k]
                held.append(batch.column(2)[int(k)].as_py())
                size += len(held[-1])
        if held:
            yield from resolve(held)

    def regroup(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        d = np.concatenate([np.frombuffer(p, np.int64, len(p) // 16) for p in parts])
        h = np.concatenate([np.frombuffer(p, np.uint64, len(p) // 16, len(p) // 2) for p in parts])
        order = np.argsort(d, kind="stable")
        d, h = d[order], h[order]
        cuts = np.flatnonzero(np.diff(d)) + 1
        low, high = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(d)]])
        lists = [h[a:b].tobytes() for a, b in zip(low, high)]
        yield pa.RecordBatch.from_arrays([pa.array(d[low]), pa.array(lists, pa.binary())], ["doc", "nodes"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != now and held:
                    yield from regroup(held)
                    held = []
                now = bucket
                held.append(data.as_py())
        if held:
            yield from regroup(held)

    grouped = routed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "bucket int, data binary")
    return grouped.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, "doc long, nodes binary")


def _own(packed: bytes | None) -> np.ndarray:
    return np.frombuffer(packed or b"", np.uint64)


def _hits(values: np.ndarray, row: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    """Which (row, value) pairs are in the list of their row."""
    salt = np.arange(len(lists), dtype=np.uint64) * FACTORS[62]
    wanted = np.concatenate([mix(x + s) for x, s in zip(lists, salt)])
    return np.isin(mix(values + row.astype(np.uint64) * FACTORS[62]), wanted)


def _per_document(text: DataFrame, nodes: DataFrame) -> DataFrame:
    """Texts with the nodes found for their document. The small side is hashed, so texts are not sorted."""
    return text.join(nodes.hint("shuffle_hash"), "doc", "left")


def remove_repeats(
    df: DataFrame, window: int = 13, key: str = "doc_id", text: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (``key`` if not given), n_words, n_removed, kept_text, kept_sha256 and repeats.

    A word is removed if a window of ``window`` words that covers it also stands in a document with a smaller key. ``kept_text``
    are the other words with one blank between; ``repeats`` are the removed runs as (first word, last word + 1). Windows
    are judged on the input. Null texts have no words. Rows with a null key neither lose words nor make others lose any. Rows of the
    same key lose nothing to each other. Columns of ``keep`` named like a result are replaced.
    """
    made = ("n_words", "n_removed", "kept_text", "kept_sha256", "repeats")
    keep = [c for c in (keep or [key]) if c not in made]
    bound_batches(df.sparkSession)
    bits = _bits(df)
    # The key itself is not carried twice, so that both passes can read one shuffle.
    carried = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep) if c != key]
    own = df.select(F.col(key).cast("bigint").alias("doc"), F.col(text).cast("string").alias("text"), *carried)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            docs, known = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for low, high, data, offsets in text_blocks(batch.column(1)):
                row, hashes, *_ = _block_suffixes(data, offsets, window)
                if not len(row):
                    continue
                # Neighbouring windows mostly have the same sample.
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
                new &= known[low + row]
                s = np.zeros(int(new.sum()), _SUFFIX)
                s["h"], s["d"] = hashes[new], docs[low + row[new]]
                held.append(s)
                size += len(s)
                if size >= _FLUSH:
                    yield from _route(held, bits, False)
                    held, size = [], 0
        yield from _route(held, bits, False)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            docs, nodes = batch.column(0).fill_null(0).to_numpy(), batch.column(2)
            chosen = np.flatnonzero(nodes.is_valid().to_numpy(zero_copy_only=False))
            if not len(chosen):
                continue
            texts, lists = batch.column(1).take(pa.array(chosen)), nodes.take(pa.array(chosen)).to_pylist()
            for low, high, data, offsets in text_blocks(texts):
                row, hashes, whole, check, *_ = _block_suffixes(data, offsets, window)
                if not len(row):
                    continue
                hit = _hits(hashes, row, [_own(x) for x in lists[low:high]])
                s = np.zeros(int(hit.sum()), _SUFFIX)
                s["h"], s["c"], s["d"] = whole[hit], check[hit], docs[chosen[low + row[hit]]]
                held.append(s)
                size += len(s)
                if size >= _FLUSH:
                    yield from _route(held, bits, True)
                    held, size = [], 0
        yield from _route(held, bits, True)

    fields = df.select(*keep).schema.fields
    schema = T.StructType(
        [
            *fields,
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept_text", T.StringType()),
            T.StructField("kept_sha256", T.StringType()),
            T.StructField("repeats", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
        ]
    )
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column(1), batch.column(2).to_pylist()
            count, removed, kept, digest, runs = [], [], [], [], []
            for low, high, data, offsets in text_blocks(texts):
                nodes = lists[low:high]
                if any(nodes):
                    row, _, whole, _, at, word_row = _block_suffixes(data, offsets, window)
                    hit = at[_hits(whole, row, [_own(x) for x in nodes])]
                    change = np.zeros(len(word_row) + 1, np.int64)
                    np.add.at(change, hit, 1)
                    np.add.at(change, hit + window, -1)
                    gone = np.cumsum(change[:-1]) > 0
                    first = np.searchsorted(word_row, np.arange(high - low + 1))
                raw = data.tobytes()
                for k in range(high - low):
                    words = raw[offsets[k] : offsets[k + 1]].split()
                    count.append(len(words))
                    own = []
                    if nodes[k]:
                        mine = gone[first[k] : first[k + 1]]
                        edges = np.flatnonzero(np.diff(np.concatenate([[0], mine.astype(np.int8), [0]])))
                        own = [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])]
                        words = [w for w, g in zip(words, mine.tolist()) if not g]
                    runs.append(own)
                    removed.append(count[-1] - len(words))
                    kept.append(b" ".join(words))
                    digest.append(sha256(kept[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[3:], pa.array(count, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(digest, pa.string()), pa.array(runs, spans)],
                [*keep, *made],
            )

    # Rows without a key would all meet in one task of the joins, where nothing waits for them.
    named, unnamed = own.filter("doc IS NOT NULL"), own.filter("doc IS NULL").withColumn("nodes", F.lit(None).cast("binary"))
    first = _gather(named.select("doc", "text").mapInArrow(sample, _ROUTED), bits, False)
    second = _gather(_per_document(named, first).select("doc", "text", "nodes").mapInArrow(windows, _ROUTED), bits, True)
    columns = [(F.col("doc").cast(df.schema[c].dataType) if c == key else F.col(f"_k{i}")).alias(f"_k{i}") for i, c in enumerate(keep)]
    judged, untouched = (rows.select("doc", "text", "nodes", *columns).mapInArrow(cut, schema) for rows in (_per_document(named, second), unnamed))
    return judged.unionByName(untouched)
