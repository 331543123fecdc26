"""Near-duplicate documents by MinHash with tensored banding; links are confirmed on full sets.

A document is a set of word shingles. Documents of equal sets are one class from the start. Two collections of
``halves`` half-keys are made, each of ``rows`` MinHash values, and the key of table (i, j) joins half-key i of the
first collection with half-key j of the second. So halves^2 tables of 2 * rows values cost 2 * halves * rows MinHash
values. Two sets of similarity s meet in some table with probability (1 - (1 - s^rows)^halves)^2, 0.9985 at 0.8 and
0.99998 at 0.9.

A half-key that one class alone has cannot meet anything, so only shared half-keys are paired, which few are.

Documents that meet form families. Inside a family all pairs are compared on full sets, in blocks of bounded size:
a block has a task to itself, and reports links that span what it found, no more than it has members. A family of many blocks is first
compared within blocks and with one of them, which costs linear work and links most copies; then only blocks that
are not yet in one component meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, give_back, settle
from .components import connected_components
from .hashing import FACTORS, find_words, hash_pieces, lower_ascii, mix, sequences, text_blocks

BLOCK_DOCS = 512
BLOCK_SHINGLES = 250_000
BROADCAST_TASKS = 1_000_000


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(first row, last row + 1, ascending distinct shingle hashes of each row) by blocks.

    A text of fewer than ``width`` words has its whole sequence as the only shingle, one without words none.
    """
    for low, high, data, offsets in text_blocks(texts):
        data = lower_ascii(data)
        starts, ends, row = find_words(data, offsets)
        words = hash_pieces(data, starts, ends)
        hashes, at = sequences(words, row, width)
        cuts = np.searchsorted(row[at], np.arange(high - low + 1))
        first = np.searchsorted(row, np.arange(high - low + 1))
        sets = []
        for k in range(high - low):
            many = first[k + 1] - first[k]
            if 0 < many < width:
                own = words[first[k] : first[k + 1]]
                total = np.uint64(0) if not many else (own * FACTORS[40 : 40 + many]).sum(dtype=np.uint64)
                sets.append(mix(np.array([total], np.uint64) ^ FACTORS[40 + width + many]))
            else:
                sets.append(np.unique(hashes[cuts[k] : cuts[k + 1]]))
        yield low, high, sets


def _signatures(df: DataFrame, width: int, halves: int, rows: int, seed: int) -> DataFrame:
    """(doc, key, n, s1, s2, a, b) per row of (doc, key, text): set size, two sums that tell sets apart, and both collections of half-keys."""
    draw = np.random.Generator(np.random.PCG64(seed))
    factor = draw.integers(1, 2**62, 2 * halves * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = draw.integers(0, 2**63, 2 * halves * rows, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, sets in shingle_sets(batch.column(2), width):
                size = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(size)
                sums = np.zeros((2, high - low), np.uint64)
                keys = np.zeros((high - low, 2 * halves), np.uint64)
                if len(full):
                    joined = np.concatenate([sets[k] for k in full])
                    cuts = np.cumsum(size[full]) - size[full]
                    for j in range(2):
                        sums[j, full] = np.add.reduceat(mix(joined ^ FACTORS[50 + j]), cuts)
                    for h in range(2 * halves):
                        key = np.full(len(full), h, np.uint64) * FACTORS[52]
                        for r in range(h * rows, h * rows + rows):
                            key = mix(key + np.minimum.reduceat(joined * factor[r] + shift[r], cuts))
                        keys[full, h] = key
                flat, offsets = keys.view(np.int64), np.arange(high - low + 1, dtype=np.int32) * halves
                lists = [
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(part).ravel()))
                    for part in (flat[:, :halves], flat[:, halves:])
                ]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(low, high - low) for k in range(2)], pa.array(size), *map(pa.array, sums.view(np.int64)), *lists],
                    ["doc", "key", "n", "s1", "s2", "a", "b"],
                )
        give_back()

    return df.mapInArrow(run, "doc long, key long, n long, s1 long, s2 long, a array<long>, b array<long>")


def _meetings(reps: DataFrame) -> DataFrame:
    """(a, b): each class with the smallest class of every table bucket it shares."""
    # A class has a key once, so keys that are counted twice are shared; counts are all that is sent for it.
    each = reps.select("doc", F.explode(F.concat("a", "b")).alias("key"))
    shared = settle(each.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key"))
    left = reps.select("doc", F.explode("a").alias("key")).join(shared, "key").groupBy("doc").agg(F.collect_list("key").alias("a"))
    right = reps.select("doc", F.explode("b").alias("key")).join(shared, "key").groupBy("doc").agg(F.collect_list("key").alias("b"))
    # Written as two lists a class; the pairs of their keys are made again where they are counted and where they are joined.
    both = settle(left.join(right, "doc")).select("doc", "b", F.explode("a").alias("i")).select("doc", "i", F.explode("b").alias("j"))
    tables = both.select("doc", F.xxhash64("i", "j").alias("key"))
    buckets = settle(tables.groupBy("key").agg(F.min("doc").alias("x"), F.max("doc").alias("y")).filter("x < y").select("key", "x"))
    return tables.join(buckets, "key").filter("doc > x").select(F.col("doc").alias("a"), F.col("x").alias("b")).distinct()


def spanning_links(left: list[tuple[int, np.ndarray]], right: list[tuple[int, np.ndarray]] | None, percent: int) -> list[tuple[int, int]]:
    """Links between documents of ``left`` and ``right`` (or within ``left``) that connect all pairs similar enough.

    Common shingles of every pair are counted exactly, by products of membership tables of bounded width.
    """
    docs = left if right is None else left + right
    size = np.array([len(s) for _, s in docs])
    owner = np.repeat(np.arange(len(docs)), size)
    order = np.argsort(flat := np.concatenate([s for _, s in docs]), kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    number = np.cumsum(new) - 1
    wide = np.bincount(number)[number] > 1
    owner, number = owner[wide], np.unique(number[wide], return_inverse=True)[1]
    cut = len(left)
    common = np.zeros((cut, len(docs) - cut if right is not None else cut), np.float32)
    for low in range(0, int(number.max(initial=-1)) + 1, 4096):
        a, b = np.searchsorted(number, [low, low + 4096])
        table = np.zeros((len(docs), 4096), np.float32)
        table[owner[a:b], number[a:b] - low] = 1
        common += table[:cut] @ (table[cut:] if right is not None else table).T
    common = common.astype(np.int64)
    one, two = size[:cut, None], (size[cut:] if right is not None else size)[None, :]
    linked = 100 * common >= percent * (one + two - common)
    parent = list(range(len(docs)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    out = []
    for x, y in zip(*map(np.ndarray.tolist, np.nonzero(linked))):
        y = y + cut if right is not None else y
        p, q = root(x), root(y)
        if p != q:
            parent[p] = q
            out.append((docs[x][0], docs[y][0]))
    return out


def _compare(placed: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) found in comparisons; ``placed`` has (doc, tasks), a list of (task, side): side 0 alone means within the block.

    Texts travel, which compress, not sets, which do not; each is sent once to each of its tasks, which cut it into shingles.
    Up to ``BROADCAST_TASKS`` entries of such lists, some 30 MB, go to where the texts are; more of them are joined by a shuffle.
    """
    placed = settle(placed)
    if (placed.agg(F.sum(F.size("tasks") + 1)).first()[0] or 0) <= BROADCAST_TASKS:
        placed = F.broadcast(placed)
    rows = texts.join(placed, "doc").select("doc", "text", F.inline("tasks")).select("task", "side", "doc", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, left, right = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            links = spanning_links(left, right or None, percent) if len(left) + len(right) > 1 and left else []
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], ["a", "b"])

        for batch in batches:
            tasks, sides, docs = (batch.column(k).to_pylist() for k in range(3))
            for low, high, sets in shingle_sets(batch.column(3), width):
                for task, side, doc, own in zip(tasks[low:high], sides[low:high], docs[low:high], sets):
                    if task != now:
                        yield from close()
                        now, left, right = task, [], []
                    (right if side else left).append((doc, own))
        yield from close()
        give_back()

    return rows.repartition("task").sortWithinPartitions("task", "side").mapInArrow(run, "a long, b long")


def _blocks(members: DataFrame, by: list[str]) -> DataFrame:
    """``members`` with ``blocks``, the number of blocks their group needs, and ``block``, drawn by hash."""
    group = Window.partitionBy(*by)
    need = F.greatest(F.ceil(F.sum("n").over(group) / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)).over(group) / BLOCK_DOCS)).cast("bigint")
    return members.withColumn("blocks", need).withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "doc"), F.col("blocks")))


def _links(texts: DataFrame, families: DataFrame, width: int, percent: int) -> DataFrame:
    """Links within families (doc, n, family) of classes; ``texts`` has (doc, text)."""
    members = settle(_blocks(families, ["family"]))
    # First round: every block within itself, and with block 0 of its family.
    none = F.array().cast("array<struct<task:bigint,side:int>>")
    apart = F.transform(
        F.when((F.col("block") == 0) & (F.col("blocks") > 1), F.sequence(F.lit(1).cast("bigint"), F.col("blocks") - 1)).otherwise(F.array().cast("array<bigint>")),
        lambda k: F.struct(F.xxhash64(F.lit("hub"), "family", k).alias("task"), F.lit(0).alias("side")),
    )
    mine = F.array(F.struct(F.xxhash64(F.lit("own"), "family", "block").alias("task"), F.lit(0).alias("side")))
    hub = F.when(F.col("block") > 0, F.array(F.struct(F.xxhash64(F.lit("hub"), "family", "block").alias("task"), F.lit(1).alias("side"))))
    placed = members.select("doc", F.concat(mine, apart, F.coalesce(hub, none)).alias("tasks"))
    first = settle(_compare(placed, texts, width, percent))
    # Second round: families of several blocks that are not one component yet.
    many = members.filter("blocks > 1").select("doc", "n", "family")
    if many.isEmpty():
        return first
    labels = connected_components(first)
    label = F.coalesce("label", "doc")
    many = many.join(labels.withColumnRenamed("node", "doc"), "doc", "left").select("doc", "n", "family", label.alias("label"))
    split = many.groupBy("family").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("family")
    many = settle(_blocks(many.join(split, "family", "left_semi"), ["family", "label"]))
    # A component that fills a block or more keeps blocks of its own; smaller ones share mixed blocks by hash.
    large = many.groupBy("family", "label").agg(F.sum("n").alias("_n"), F.count(F.lit(1)).alias("_c"))
    large = large.withColumn("pure", (F.col("_n") >= BLOCK_SHINGLES // 2) | (F.col("_c") >= BLOCK_DOCS // 2))
    mixed = many.join(large.select("family", "label", "pure"), ["family", "label"])
    rest = _blocks(mixed.filter(~F.col("pure")).select("doc", "n", "family", "label"), ["family"])
    home = mixed.filter("pure").select("doc", "family", "label", F.xxhash64(F.lit("pure"), "label", "block").alias("home"))
    home = settle(home.unionByName(rest.select("doc", "family", F.lit(None).cast("bigint").alias("label"), F.xxhash64(F.lit("mixed"), "family", "block").alias("home"))))
    blocks = home.select("family", "home", "label").distinct()
    other = blocks.select("family", F.col("home").alias("home2"), F.col("label").alias("label2"))
    pairs = blocks.join(other, "family").filter("home <= home2 AND NOT coalesce(label = label2, false)")
    task = F.xxhash64(F.lit("pair"), "home", "home2").alias("task")
    one = home.join(pairs.select("home", task), "home").select("doc", "task", F.lit(0).alias("side"))
    two = home.join(pairs.filter("home < home2").select(F.col("home2").alias("home"), task), "home").select("doc", "task", F.lit(1).alias("side"))
    again = one.unionByName(two).select("doc", F.array(F.struct("task", "side")).alias("tasks"))
    return first.unionByName(_compare(again, texts, width, percent))


def _number(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written with a number of each row, and the name of that column, which ``df`` does not have."""
    name = "_row"
    while name in map(str.lower, df.columns):
        name += "_"
    return settle(df.withColumn(name, F.monotonically_increasing_id())), name


_SAME = ["n", "s1", "s2"]


def _classes(texts: DataFrame, usable: str, width: int, percent: int, halves: int, rows: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(doc, key, n, s1, s2) of each row, and (n, s1, s2, best, label) of each set that ``usable`` rows have.

    ``texts`` has (doc, key, text), ``doc`` being the written number of a row. ``best`` is the (_none, key, doc) that
    comes first among the rows of a set, null keys last, and stands for it: a set is compared once, however many rows
    have it. Sets of one component share a ``label``.
    """
    marks = settle(_signatures(texts, width, halves, rows, seed))
    first = F.min(F.struct(F.col("key").isNull().alias("_none"), "key", "doc")).alias("best")
    classes = settle(marks.filter(usable).groupBy(*_SAME).agg(first).withColumn("node", F.col("best.doc")))
    reps = marks.join(classes.select(F.col("node").alias("doc")), "doc", "left_semi").select("doc", "a", "b")
    meetings = settle(_meetings(reps))
    # The sizes of sets are known, so blocks are planned before any text is moved.
    sizes = classes.select(F.col("node").alias("doc"), "n")
    families = sizes.join(connected_components(meetings).select(F.col("node").alias("doc"), F.col("label").alias("family")), "doc")
    labels = settle(connected_components(_links(texts.select("doc", "text"), families, width, percent)))
    found = classes.join(labels, "node", "left").select(*_SAME, "best", F.coalesce("label", "node").alias("label"))
    return marks.select("doc", "key", *_SAME), settle(found)


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    halves: int = 10,
    rows: int = 3,
    seed: int = 7,
) -> DataFrame:
    """``key``, n_shingles, component_id and kept, a row per row of ``df``.

    Words are runs of anything but ASCII blanks, A to Z lower-cased. The set of a text are its distinct shingles of
    ``width`` words; a shorter text has its whole word sequence as the only one, and a text without words, or null, an empty set,
    which links to nothing. Documents are linked if intersection over union is ``percent`` per cent or more.
    ``component_id`` is the smallest key that links lead to, itself included; ``kept`` marks it, in every row that has it. Rows
    that repeat a key are placed each by its own text; see ``one_of_each`` for one row of each component. A row with a
    null key links to nothing: its component is null, and it is kept.
    """
    bound_batches(df.sparkSession)
    numbered, row = _number(df.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text")))
    texts = numbered.select(F.col(row).alias("doc"), "key", "text")
    marks, found = _classes(texts, "key IS NOT NULL AND n > 0", width, percent, halves, rows, seed)
    smallest = found.groupBy("label").agg(F.min("best.key").alias("component_id"))
    roots = found.join(smallest, "label").select(*_SAME, "component_id")
    filled = F.when(F.col("key").isNotNull() & (F.col("n") > 0), F.col("component_id")).otherwise(F.col("key"))
    joined = marks.join(roots, _SAME, "left").select("key", "n", filled.alias("component_id"))
    return joined.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("key") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def one_of_each(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    halves: int = 10,
    rows: int = 3,
    seed: int = 7,
) -> DataFrame:
    """The rows and columns of ``df``, of each component of near copies exactly one row: that of the smallest key.

    Components are those of ``near_duplicates``, but rows alone count: a key may be on rows of several components, and
    rows with a null key link like others and come last. Texts without words link to nothing and stay.
    """
    bound_batches(df.sparkSession)
    numbered, row = _number(df)
    texts = numbered.select(F.col(row).alias("doc"), F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    marks, found = _classes(texts, "n > 0", width, percent, halves, rows, seed)
    stay = found.groupBy("label").agg(F.min("best").alias("best")).select(F.col("best.doc").alias(row))
    stay = stay.unionByName(marks.filter("n = 0").select(F.col("doc").alias(row)))
    return numbered.join(stay, row, "left_semi").select(*df.columns)
