"""Fingerprints of documents that add up, with DataFrame and SQL functions only.

A paragraph is a non-empty line. It is hashed to a wide vector, and the vectors of all paragraphs are added lane by
lane modulo a power of two. So the fingerprint is that of the multiset of paragraphs: their order does not matter,
and a paragraph is put in or taken out by adding or subtracting its vector.

The vector has two parts. Eight dense lanes modulo 2^32 hold the paragraph's SHA-256; they decide equality. Sparse
lanes modulo 2^16 stand for its pieces: what lies between punctuation marks, cut again at 32 code points. Each piece
adds a value from its hash to one lane of 512 on level 0, and on level k as well if its hash is divisible by 4^k. So
level k holds a sample of one piece in 4^k, and a text of any length has a level that is not full, from which the
likeness is read. Zero lanes are not stored: short texts have short fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, whole_text

DENSE, SLOTS, LEVELS, PIECE = 8, 512, 16, 32
_DENSE_MOD, _SPARSE_MOD = 1 << 32, 1 << 16
# A level serves while at most this many of its lanes are in use by the two texts together.
_FULL = 360
_CUT = "([.,;:!?\u3002\uff0c\u3001\uff01\uff1f\uff1b\uff1a] ?)"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hex(digest: Column, at: int, size: int) -> Column:
    return F.conv(F.substring(digest, at, size), 16, 10).cast("bigint")


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(whole_text(text), "\n", -1), lambda p: p != "")


def _digests(text: Column) -> Column:
    return F.transform(paragraphs(text), lambda p: F.sha2(p, 256))


def pieces(text: Column) -> Column:
    """The pieces of all paragraphs; none crosses a line break, so they depend on their paragraph alone."""
    cut = F.regexp_replace(whole_text(text), _CUT, "$1\n")
    return F.regexp_extract_all(cut, F.lit("[^\n]{1,%d}" % PIECE), F.lit(0))


def _entry(h: Column, level: Column) -> Column:
    """Lane and value of a piece on a level in one number, lane * 2^16 + value; values are never zero."""
    lane = level * SLOTS + F.pmod(h, F.lit(SLOTS))
    return lane * _SPARSE_MOD + F.pmod(F.shiftright(h, 39), F.lit(_SPARSE_MOD - 1)) + 1


def _deepest(h: Column) -> Column:
    """How often 4 divides the level bits of a hash."""
    bits = F.shiftright(h, 9).bitwiseAND(F.lit((1 << 30) - 1)).bitwiseOR(F.lit(1 << 30))
    return F.floor(F.bit_count(bits.bitwiseAND(-bits) - 1) / 2)


def _entries(text: Column) -> Column:
    def spread_over(hashes: Column) -> Column:
        first = F.transform(hashes, lambda h: _entry(h, F.lit(0).cast("bigint")))
        sampled = F.filter(hashes, lambda h: F.pmod(F.shiftright(h, 9), F.lit(4)) == 0)
        one = F.lit(1).cast("bigint")
        deeper = F.flatten(F.transform(sampled, lambda h: F.transform(F.sequence(one, _deepest(h)), lambda k: _entry(h, k))))
        return F.concat(first, deeper)

    return _let(F.transform(pieces(text), lambda p: _hex(F.md5(p), 1, 15)), spread_over)


def _summed(entries: Column) -> Column:
    """Entries of one lane added up, in order of lanes; lanes that come to zero are left out."""
    start = F.struct(
        F.array().cast("array<bigint>").alias("done"), F.lit(-1).cast("bigint").alias("lane"), F.lit(0).cast("bigint").alias("total")
    )

    def close(acc: Column) -> Column:
        total = F.pmod(acc["total"], F.lit(_SPARSE_MOD))
        return F.when(total == 0, acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["lane"] * _SPARSE_MOD + total)))

    def step(acc: Column, entry: Column) -> Column:
        lane, value = F.shiftright(entry, 16), F.pmod(entry, F.lit(_SPARSE_MOD))
        same = F.struct(acc["done"].alias("done"), acc["lane"].alias("lane"), (acc["total"] + value).alias("total"))
        return F.when(lane == acc["lane"], same).otherwise(F.struct(close(acc).alias("done"), lane.alias("lane"), value.alias("total")))

    return F.aggregate(F.sort_array(entries), start, step, close)


def lanes(text: Column) -> Column:
    """The fingerprint: values of the dense lanes, then lane * 2^16 + value of each sparse lane that is not zero."""

    def build(digests: Column) -> Column:
        def lane(k: int) -> Column:
            total = F.aggregate(digests, F.lit(0).cast("bigint"), lambda a, d: a + _hex(d, 8 * k + 1, 8))
            return F.pmod(total, F.lit(_DENSE_MOD))

        return F.concat(F.array(*[lane(k) for k in range(DENSE)]), _summed(_entries(text)))

    return _let(_digests(text), build)


def _sparse(lane_values: Column) -> Column:
    return F.slice(lane_values, DENSE + 1, F.size(lane_values))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Lanes of the paragraphs of both (``sign`` 1), or of ``a`` without those of ``b`` (``sign`` -1)."""
    dense = F.zip_with(F.slice(a, 1, DENSE), F.slice(b, 1, DENSE), lambda x, y: F.pmod(x + sign * y, F.lit(_DENSE_MOD)))
    other = _sparse(b)
    if sign < 0:
        other = F.transform(other, lambda e: F.shiftright(e, 16) * _SPARSE_MOD + _SPARSE_MOD - F.pmod(e, F.lit(_SPARSE_MOD)))
    return F.concat(dense, _summed(F.concat(_sparse(a), other)))


def to_text(lane_values: Column) -> Column:
    """Lower-case hexadecimal, eight digits a dense lane and eight a sparse one that is not zero."""
    return F.lower(F.array_join(F.transform(lane_values, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints; otherwise about the share of pieces that both texts hold among those that either holds.

    Lanes in use tell how many different pieces a text has, and lanes that differ tell how many are in one text only
    (``-SLOTS * ln(share of lanes not hit)``, since pieces may share a lane). A piece that both repeat, but not equally
    often, counts as different. Rounded to six decimals.
    """

    def shared(parts: Column) -> Column:
        used_a, used_b = (F.transform(parts[k], lambda e: F.shiftright(e, 16)) for k in "ab")
        common = F.transform(F.array_intersect(parts["a"], parts["b"]), lambda e: F.shiftright(e, 16))
        return _let(F.struct(used_a.alias("a"), used_b.alias("b"), F.array_union(used_a, used_b).alias("u"), common.alias("c")), estimate)

    def used(of: Column, level: Column) -> Column:
        return F.size(F.filter(of, lambda lane: F.shiftright(lane, 9) == level))

    def estimate(sets: Column) -> Column:
        open_levels = F.filter(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda k: used(sets["u"], k) <= _FULL)
        level = F.when(F.size(sets["u"]) <= _FULL, F.lit(0)).otherwise(F.coalesce(F.get(open_levels, F.lit(0)), F.lit(LEVELS - 1)))

        def ratio(k: Column) -> Column:
            def number(n: Column) -> Column:
                return -SLOTS * F.log(1 - F.least(n, F.lit(SLOTS - 1)) / SLOTS)

            own, other = number(used(sets["a"], k)), number(used(sets["b"], k))
            apart = number(used(sets["u"], k) - used(sets["c"], k))
            return F.greatest(F.coalesce(F.try_divide(own + other - apart, own + other + apart), F.lit(0.0)), F.lit(0.0))

        return _let(level, ratio)

    share = _let(F.struct(_sparse(a).alias("a"), _sparse(b).alias("b")), shared)
    # Different documents may agree in every sparse lane by chance, but never count as equal.
    return F.when(a == b, F.lit(1.0)).otherwise(F.round(F.least(share, F.lit(1.0 - 1.0 / SLOTS)), 6))


def _packed(lane_values: Column) -> Column:
    """Lanes as they travel: sparse ones fit into four bytes."""
    return _let(lane_values, lambda x: F.struct(F.slice(x, 1, DENSE).alias("dense"), _sparse(x).cast("array<int>").alias("sparse")))


def _unpacked(column: str) -> Column:
    return F.concat(f"{column}.dense", F.col(f"{column}.sparse").cast("array<bigint>"))


def fingerprint(df: DataFrame, text: str = "text", out: str = "lanes") -> DataFrame:
    """All rows and columns with the lanes of their text; null and empty texts have the dense lanes alone, all zero."""
    return df.withColumn(out, lanes(F.col(text)))


# Who a document is, in columns that are never null, so that joins and windows on them share one partitioning.
_WHO = ["_none", "_id", "_x"]


def _identity(df: DataFrame, key: str, text: str) -> list[Column]:
    missing = F.lit(0).cast(df.schema[key].dataType)
    return [F.col(key).isNull().alias("_none"), F.coalesce(F.col(key), missing).alias("_id"), F.xxhash64(whole_text(F.col(text))).alias("_x")]


def ring(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(_none, _id, _x) of each document with that and half the length of the document before it, as ``_before``.

    Documents stand in a ring by ascending key, null keys last; equal keys are ordered by a hash of the text, and
    rows equal in both are one document. Keys alone are sorted: rows are cut into ranges, each range is linked
    inside, and one row per range links the ranges.
    """
    half = F.floor(F.length(whole_text(F.col(text))) / 2).cast("int").alias("_half")
    known = df.select(*_identity(df, key, text), half).dropDuplicates(_WHO)
    ranged = settle(known.repartitionByRange(*_WHO).withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy("_range").orderBy(*_WHO)
    me = F.struct(*_WHO, "_half")
    linked = ranged.select("*", F.lag(me).over(inside).alias("_near"), F.lead(F.lit(1)).over(inside).isNull().alias("_ends"))
    ends = linked.filter("_ends").select("_range", me.alias("_last"))
    around = Window.orderBy("_range")
    final = F.max_by("_last", "_range").over(Window.partitionBy())
    doors = ends.select("_range", F.coalesce(F.lag("_last").over(around), final).alias("_door"))
    return linked.join(doors, "_range").select(*_WHO, F.coalesce("_near", "_door").alias("_before"))


def edited_fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document, of its edited text, and how alike both and the next document are.

    The edited text has its last half replaced by as many first code points of the next document. Texts cross the
    network once, joined with their place in the ring and their lanes, which are computed once; only the beginnings and
    lanes that the neighbours need move again.
    Columns: ``key``, n_chars, edited, lanes, edited_lanes, near_edited, near_next.
    """
    own = df.select(*_identity(df, key, text), whole_text(F.col(text)).alias("_text"), _packed(lanes(F.col(text))).alias("_lanes"))
    placed = own.join(ring(df, key, text), _WHO)
    # Of rows that are one document, one gives its beginning.
    first = F.row_number().over(Window.partitionBy(*_WHO).orderBy(*_WHO))
    gives = placed.withColumn("_nth", first).filter("_nth = 1").select(
        *[F.col(f"_before.{c}").alias(c) for c in _WHO],
        F.left("_text", F.col("_before._half")).alias("_start"),
        F.col("_lanes").alias("_next"),
    )
    joined = placed.join(gives, _WHO)
    length = F.length("_text")
    kept = F.left("_text", (length - F.floor(length / 2)).cast("int"))
    texts = joined.select(F.when(~F.col("_none"), F.col("_id")).alias("_id"), length.cast("bigint").alias("n_chars"), F.concat(kept, "_start").alias("edited"), _unpacked("_lanes").alias("lanes"), _unpacked("_next").alias("_next"))
    both = texts.select("*", lanes(F.col("edited")).alias("edited_lanes"))
    return both.select(
        F.col("_id").alias(key),
        "n_chars",
        "edited",
        "lanes",
        "edited_lanes",
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("_next")).alias("near_next"),
    )
