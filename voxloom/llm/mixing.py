"""Mixing sources to target weights, with DataFrame and SQL functions only.

Every source is a stream: its documents in an order drawn by hash, over again for every repeat, cut off where the
source has given its target of words. The stream is cut into blocks of words. A multivariate-hypergeometric
splitting tree shares the blocks of all sources among output shards: at each node the left half takes half of the
blocks, and how many of each source is drawn as if all blocks lay shuffled in one urn, so the quotas of every
source stay exact. Each leaf then takes its quota as the next range of a permutation of the source's blocks, so
shards are disjoint, and rows are shuffled inside their shard by a hash.

Places in a stream are running totals. They are summed in three levels over leading bits of the hash, of at most
256 rows each above the documents, so no window holds a source, however large it is. Only the tree works on one
row, which has a number per source; sources are few, since each has a weight that somebody chose.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, hash60, settle

# Primes above any number of blocks; one of them is the factor of a source's block permutation.
_FACTORS = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549, 2147483543, 2147483497)


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("bigint")


def _key(source: str) -> Column:
    """A source as a string that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def source_targets(sized: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """One row per source: key, rank by code point (null last), words, weight and target.

    All words are shared by weight; what exceeds ``most`` times a source's words is shared among the others by
    weight until nobody exceeds. The end of that is a common level: a source gets its weight times the level, or
    its limit. Sources in order of limit per weight, the limited ones come first.
    """
    total = sized.groupBy("_source").agg(F.sum("size").alias("words"))
    by_name = Window.orderBy(F.col("_source") == "", "_source")
    ranked = total.select("*", F.row_number().over(by_name).alias("rank")).withColumn(
        "weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1)
    )
    limit = (F.col("words") * most).alias("limit")
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ranked.select("*", limit).select(
        "*",
        (F.sum("words").over(everything) - F.coalesce(F.sum("limit").over(earlier), F.lit(0))).alias("left"),
        F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)).alias("heavy"),
    )
    wide = "decimal(38,0)"
    capped = F.col("limit").cast(wide) * F.col("heavy") <= F.col("weight").cast(wide) * F.col("left")
    marked = level.withColumn("capped", capped)
    rest = [F.min_by(c, "place").over(everything).alias(f"free_{c}") for c in ("left", "heavy")]
    free = marked.withColumn("place", F.when(~F.col("capped"), F.row_number().over(by_level))).select("*", *rest)
    share = F.try_divide((F.col("weight") * F.col("free_left")).cast("double"), F.col("free_heavy").cast("double"))
    target = F.when(F.col("capped"), F.col("limit").cast("double")).otherwise(share)
    return free.select("_source", "rank", "words", "weight", target.alias("target"))


def _draw(white: Column, black: Column, drawn: Column, unit: Column) -> Column:
    """How many of ``drawn`` balls are white: the hypergeometric quantile at ``unit``.

    Weights follow from each other by their ratio and are summed over twelve deviations around the mode, beyond
    which nothing is left in double precision.
    """

    def let(value: Column, body) -> Column:
        return F.get(F.transform(F.array(value), body), F.lit(0))

    whole = white + black
    share = F.try_divide(white.cast("double"), whole.cast("double"))
    spread = F.sqrt(F.abs(drawn * share * (1 - share) * (whole - drawn) / F.greatest(whole - 1, F.lit(1))))
    mode = F.floor((drawn + 1).cast("double") * (white + 1) / (whole + 2))
    least = F.greatest(F.lit(0).cast("bigint"), drawn - black)
    most = F.least(white, drawn)
    low = F.greatest(least, (mode - F.ceil(spread * 12) - 12).cast("bigint"))
    high = F.least(most, (mode + F.ceil(spread * 12) + 12).cast("bigint"))

    def ratio(k: Column) -> Column:
        up = (white - k).cast("double") * (drawn - k)
        return up / ((k + 1).cast("double") * (black - drawn + k + 1))

    def quantile(bounds: Column) -> Column:
        steps = F.when(bounds["high"] > bounds["low"], F.sequence(bounds["low"], bounds["high"] - 1)).otherwise(
            F.array().cast("array<bigint>")
        )
        total = F.aggregate(
            steps,
            F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum")),
            lambda acc, k: F.struct((acc["w"] * ratio(k)).alias("w"), (acc["sum"] + acc["w"] * ratio(k)).alias("sum")),
            lambda acc: acc["sum"],
        )
        return let(
            total * unit,
            lambda bar: F.aggregate(
                steps,
                F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"), bounds["low"].alias("at")),
                lambda acc, k: F.struct(
                    (acc["w"] * ratio(k)).alias("w"),
                    (acc["sum"] + acc["w"] * ratio(k)).alias("sum"),
                    F.when(acc["sum"] <= bar, k + 1).otherwise(acc["at"]).alias("at"),
                ),
                lambda acc: acc["at"],
            ),
        )

    return F.when(whole == 0, F.lit(0).cast("bigint")).otherwise(
        let(F.struct(low.alias("low"), high.alias("high")), quantile)
    )


def _split(quotas: Column, drawn: Column, node: Column, seed: int) -> Column:
    """The part of each quota that goes left, ``drawn`` in all: one conditional draw per source."""
    places = F.transform(quotas, lambda q, k: F.struct(q.alias("q"), k.alias("k")))
    start = F.struct(
        drawn.cast("bigint").alias("open"),
        F.aggregate(quotas, F.lit(0).cast("bigint"), lambda a, q: a + q).alias("rest"),
        F.array().cast("array<bigint>").alias("taken"),
    )

    def step(acc: Column, p: Column) -> Column:
        unit = F.pmod(F.xxhash64(F.lit(f"tree:{seed}"), node, p["k"]), F.lit(1 << 53)) / float(1 << 53)
        one = F.array(_draw(p["q"], acc["rest"] - p["q"], acc["open"], unit))
        return F.get(
            F.transform(
                one,
                lambda x: F.struct(
                    (acc["open"] - x).alias("open"),
                    (acc["rest"] - p["q"]).alias("rest"),
                    F.concat(acc["taken"], F.array(x)).alias("taken"),
                ),
            ),
            F.lit(0),
        )

    return F.aggregate(places, start, step, lambda acc: acc["taken"])


def splitting_tree(quotas: DataFrame, depth: int, seed: int = 0) -> DataFrame:
    """(shard, rank, blocks, before) from (rank, quota): 2^depth shards of equal size to within one block.

    ``before`` is the number of the source's blocks in earlier shards.
    """
    listed = F.array_sort(F.collect_list(F.struct("rank", "quota")))
    nodes = quotas.agg(
        F.transform(listed, lambda x: x["quota"]).alias("quotas"), F.transform(listed, lambda x: x["rank"]).alias("ranks")
    ).withColumn("node", F.lit(0).cast("bigint"))
    for level in range(depth):
        total = F.aggregate("quotas", F.lit(0).cast("bigint"), lambda a, q: a + q)
        label = F.col("node") + (1 << level)
        half = _split(F.col("quotas"), F.floor((total + 1) / 2), label, seed)
        both = F.transform(
            F.array(half),
            lambda left: F.array(
                F.struct((F.col("node") * 2).alias("node"), left.alias("quotas")),
                F.struct(
                    (F.col("node") * 2 + 1).alias("node"), F.zip_with("quotas", left, lambda q, x: q - x).alias("quotas")
                ),
            ),
        )
        nodes = nodes.select("ranks", F.inline(F.flatten(both)))
    leaves = nodes.select(
        F.col("node").cast("int").alias("shard"), F.inline(F.arrays_zip(F.col("ranks").alias("rank"), F.col("quotas").alias("blocks")))
    )
    earlier = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return leaves.select("*", F.coalesce(F.sum("blocks").over(earlier), F.lit(0)).alias("before"))


def _fill(could: DataFrame, missing: DataFrame, most: int) -> DataFrame:
    """(row, _source, size): further copies of documents, fewest copies and largest first, as long as any fits.

    Documents of one size and level of copies are a class. A fold over the classes of a source says how many each
    gives; after it none is left that fits. Of a class that gives a part, rows are picked by counts in two levels.
    """
    spare = could.join(missing, "_source").filter("size <= _missing")
    each = spare.withColumn("_level", F.explode(F.sequence(F.col("_have") + 1, F.lit(most))))
    same = ["_source", "_level", "size"]
    classes = each.groupBy(*same, "_missing").agg(F.count(F.lit(1)).alias("n"))
    listed = F.array_sort(F.collect_list(F.struct("_level", (-F.col("size")).alias("_minus"), "n")))
    kind = "array<struct<_level:int,size:bigint,n:bigint,k:bigint>>"

    def step(acc: Column, c: Column) -> Column:
        size = -c["_minus"]
        k = F.least(c["n"], F.floor(acc["gap"] / size)).cast("bigint")
        given = F.array(F.struct(c["_level"].alias("_level"), size.alias("size"), c["n"].alias("n"), k.alias("k"))).cast(kind)
        more = F.struct((acc["gap"] - k * size).alias("gap"), F.concat(acc["given"], given).alias("given"))
        return F.when(k > 0, more).otherwise(acc)

    start = F.struct(F.max("_missing").alias("gap"), F.array().cast(kind).alias("given"))
    folded = classes.groupBy("_source").agg(listed.alias("_list"), start.alias("_start"))
    given = folded.select("_source", F.inline(F.aggregate("_list", F.col("_start"), step, lambda acc: acc["given"])))
    chosen = settle(each.join(given, same).withColumn("_part", F.pmod(F.xxhash64("row"), F.lit(4096))).select("row", *same, "n", "k", "_part"))
    part = chosen.filter("k < n")
    counts = part.groupBy(*same, "_part").agg(F.count(F.lit(1)).alias("_c"))
    before = F.sum("_c").over(Window.partitionBy(*same).orderBy("_part")) - F.col("_c")
    nth = F.row_number().over(Window.partitionBy(*same, "_part").orderBy("row"))
    some = part.withColumn("_nth", nth).join(counts.withColumn("_before", before), [*same, "_part"]).filter("_before + _nth <= k")
    return chosen.filter("k = n").select("row", "_source", "size").unionByName(some.select("row", "_source", "size"))


def _last_documents(placed: DataFrame, most: int, rounds: int = 4) -> DataFrame:
    """(row, _more): copies that end each source near its target.

    The first rounds take the largest document that still fits, the next the one whose size comes closest to what is
    missing, more than that only if it ends within a word or nothing fits. Then all that fit are taken, and last
    again the closest one, if that brings the source nearer. So no untaken document is left that would; those of the
    first rounds give no further copy.
    """
    open_words = F.max("target") - F.sum(F.col("_copies") * F.col("size"))
    missing = settle(placed.groupBy("_source").agg(open_words.alias("_missing")))
    could = placed.filter((F.col("_copies") < most) & (F.col("size") > 0)).select("_source", "row", "size", "_at", "_key", F.col("_copies").alias("_have"))

    def one(could: DataFrame, missing: DataFrame, over: bool) -> DataFrame:
        off = F.abs(F.col("size") - F.col("_missing"))
        near = (F.col("size") <= F.col("_missing")) | (F.lit(over) & (off < F.col("_missing")))
        order = [off.alias("off"), F.col("_at"), F.col("_key"), F.col("row"), F.col("size")]
        best = F.min(F.struct(*order)).alias("best")
        fits = F.min(F.when(F.col("size") <= F.col("_missing"), F.struct(*order))).alias("fits")
        picked = could.join(missing, "_source").filter(near).groupBy("_source").agg(best, fits)
        use = F.when((F.col("best.off") < 1) | F.col("fits").isNull(), F.col("best")).otherwise(F.col("fits"))
        return settle(picked.select("_source", use.alias("_use")).select("_source", "_use.row", "_use.size"))

    def after(missing: DataFrame, picked: DataFrame) -> DataFrame:
        got = picked.groupBy("_source").agg(F.sum("size").alias("_got"))
        return missing.join(got, "_source", "left").select("_source", (F.col("_missing") - F.coalesce("_got", F.lit(0))).alias("_missing"))

    def less(could: DataFrame, picked: DataFrame) -> DataFrame:
        now = picked.groupBy("row").agg(F.count(F.lit(1)).cast("int").alias("_now"))
        left = could.join(now, "row", "left").withColumn("_have", F.col("_have") + F.coalesce("_now", F.lit(0))).drop("_now")
        return left.filter(F.col("_have") < most)

    chosen = None
    for k in range(rounds):
        picked = one(could, missing, k == rounds - 1)
        missing, could = after(missing, picked), could.join(picked.select("row"), "row", "left_anti")
        chosen = picked if chosen is None else chosen.unionByName(picked)
    filled = settle(_fill(could, missing, most))
    last = one(less(could, filled), after(missing, filled), True)
    chosen = chosen.unionByName(filled.select(*chosen.columns)).unionByName(last)
    return chosen.groupBy("row").agg(F.count(F.lit(1)).cast("int").alias("_more"))


def mix(
    df: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    depth: int = 6,
    block_words: int = 65_536,
    seed: int = 0,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    row: str | None = None,
) -> DataFrame:
    """A row per document and copy the mix takes; a document that is not taken has one row without a copy.

    Columns: ``key``, ``row`` (a number of the input row, or its column of that name), ``size`` (words), ``source_size``, ``target``, ``copy``
    (0, 1, ... or null), ``block``, ``shard`` and ``order`` (rank it by this inside the shard). The first documents
    of a stream are taken as far as they fit; a few more, chosen by size, bring the source near its target. Null texts have no words; null sources are a source of their own; equal
    keys are separate rows; a null key draws its place from the text. An empty table gives an empty one.
    """
    spare = F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    draw = hash60(F.concat(F.lit(f"mix:{seed}:"), F.coalesce(F.col(key).cast("string"), spare)))
    sized = settle(
        df.select(
            F.col(key).alias("_key"),
            _key(source).alias("_source"),
            word_count(F.col(text).cast("string")).alias("size"),
            draw.alias("_h"),
            (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
        )
    ).withColumns({"_b1": F.shiftright("_h", 52), "_b2": F.shiftright("_h", 44)})
    sources = source_targets(sized, weights, most)

    def before(rows: DataFrame, within: Sequence[str], order: Sequence[str], size: str) -> Column:
        window = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(size).over(window), F.lit(0))

    fine = sized.groupBy("_source", "_b1", "_b2").agg(F.sum("size").alias("words"))
    coarse = fine.groupBy("_source", "_b1").agg(F.sum("words").alias("words"))
    coarse = coarse.withColumn("_above", before(coarse, ["_source"], ["_b1"], "words")).drop("words")
    coarse = coarse.join(sources.select("_source", "rank", F.col("words").alias("source_size"), "target"), "_source")
    fine = fine.withColumn("_inside", before(fine, ["_source", "_b1"], ["_b2"], "words"))
    fine = fine.join(coarse, ["_source", "_b1"]).withColumn("_start", F.col("_above") + F.col("_inside"))
    fine = fine.select("_source", "_b2", "_start", "rank", "source_size", "target")
    placed = sized.withColumn("_at", before(sized, ["_source", "_b2"], ["_h", "_key", "size", "row"], "size"))
    placed = placed.join(fine, ["_source", "_b2"]).withColumn("_at", F.col("_at") + F.col("_start"))
    # As many whole copies as end within the target.
    fits = F.floor(F.try_divide(F.col("target") - F.col("_at") - F.col("size"), F.col("source_size"))) + 1
    copies = F.greatest(F.lit(0), F.least(F.lit(most), F.coalesce(fits, F.lit(0)))).cast("int")
    placed = settle(placed.select("_key", "row", "_source", "rank", "size", "source_size", "target", "_at", copies.alias("_copies")))

    more = _last_documents(placed, most)
    counted = placed.join(more, "row", "left").withColumn("_copies", F.col("_copies") + F.coalesce("_more", F.lit(0)))

    quota = F.greatest(F.ceil(F.col("target") / block_words), F.lit(1)).cast("bigint")
    streams = sources.select("_source", "rank", quota.alias("quota"))
    tree = splitting_tree(streams.select("rank", "quota"), depth, seed)
    factor = F.element_at(
        F.array(*[F.lit(p) for p in _FACTORS]),
        (F.pmod(F.xxhash64(F.lit(f"factor:{seed}"), "rank"), F.lit(len(_FACTORS))) + 1).cast("int"),
    )
    shift = F.pmod(F.xxhash64(F.lit(f"shift:{seed}"), "rank"), F.col("quota"))
    blocks = streams.select("rank", "quota", factor.alias("_f"), shift.alias("_s"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("quota") - 1)).alias("block"))
    blocks = blocks.select("rank", "block", F.pmod(F.col("block") * F.col("_f") + F.col("_s"), F.col("quota")).alias("_turn"))
    ranges = tree.filter("blocks > 0").select("rank", "shard", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("blocks") - 1)).alias("_turn"))
    homes = blocks.join(ranges, ["rank", "_turn"]).select("rank", "block", "shard")

    each = F.when(F.col("_copies") > 0, F.sequence(F.lit(0), F.col("_copies") - 1))
    last = F.greatest(F.ceil(F.col("target") / block_words), F.lit(1)).cast("bigint") - 1
    rows = counted.withColumn("copy", F.explode_outer(each)).withColumn(
        "block", F.least(last, F.floor((F.col("copy") * F.col("source_size") + F.col("_at")) / block_words))
    )
    rows = rows.withColumn("block", F.when(F.col("copy").isNotNull(), F.col("block")))
    order = F.when(F.col("copy").isNotNull(), F.xxhash64(F.lit(f"order:{seed}"), "row", "copy"))
    return rows.join(homes, ["rank", "block"], "left").select(
        F.col("_key").alias(key), "row", "size", "source_size", "target", "copy", "block", "shard", order.alias("order")
    )


def mixed_rows(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The mixed table itself: every column of ``df``, a row per copy taken, with ``shard`` and ``order`` added.

    Write it with a folder per shard, rows in their order; see ``write_mixed``. Rows are written with a number of their
    own, and each comes as often as ``mix`` takes that row, whatever others agree with it. Columns of ``df`` named
    ``shard`` or ``order`` are replaced.
    """
    columns = [c for c in df.columns if c not in ("shard", "order")]
    name = "_row"
    while name in map(str.lower, df.columns):
        name += "_"
    numbered = settle(df.withColumn(name, F.monotonically_increasing_id()))
    taken = mix(numbered, key=key, text=text, row=name, **options).filter("copy IS NOT NULL")
    return numbered.select(name, *columns).join(taken.select(F.col("row").alias(name), "shard", "order"), name).select(*columns, "shard", "order")


def write_mixed(mixed: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder per shard, rows in shuffled order inside their file."""
    mixed.hint("rebalance", F.col("shard")).sortWithinPartitions("shard", "order").drop("order").write.mode(mode).partitionBy("shard").parquet(path)
