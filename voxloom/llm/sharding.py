"""Shard placement by a permutation-filled lookup table.

Every shard has an order of preference over the slots of a table of prime size: a start and a step, both from a
hash of its name, which visit every slot. Shards take turns in claiming the next slot they prefer among the free
ones until none is free. A key belongs to the owner of the slot it hashes to. Shards get equal numbers of slots
to within one a turn, and if a shard goes away, few keys of the others move.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash60

# About a hundred slots a shard keep shares within one percent of each other.
SLOTS = 6553


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def _number(text: str) -> int:
    return int(md5(text.encode()).hexdigest()[:15], 16)


def preference(name: str, slots: int) -> tuple[int, int]:
    """First slot and step of a shard's order of preference."""
    return _number(f"start:{name}") % slots, _number(f"step:{name}") % (slots - 1) + 1


def fill_table(names: Sequence[str], slots: int = SLOTS, weights: Mapping[str, int] | None = None) -> list[int]:
    """Owner, as a place in ``names``, of every slot. A shard of weight w claims w slots a turn (1 if not given)."""
    if not is_prime(slots) or not names or len(set(names)) != len(names) or len(names) > slots:
        raise ValueError("needs a prime number of slots, and distinct names, no more than slots")
    orders = [preference(name, slots) for name in names]
    turns = [max(0, int((weights or {}).get(name, 1))) for name in names]
    if not any(turns):
        raise ValueError("some shard needs a weight")
    owner, reached, free = [-1] * slots, [0] * len(names), slots
    while free:
        for k, (start, step) in enumerate(orders):
            for _ in range(min(turns[k], free)):
                slot = (start + reached[k] * step) % slots
                while owner[slot] >= 0:
                    reached[k] += 1
                    slot = (start + reached[k] * step) % slots
                owner[slot], free = k, free - 1
                reached[k] += 1
            if not free:
                break
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(hash60(key), F.lit(slots)).cast("int")


def place(
    df: DataFrame,
    names: Sequence[str],
    key: str = "doc_id",
    spare: str = "text",
    slots: int = SLOTS,
    weights: Mapping[str, int] | None = None,
    out: tuple[str, str] = ("slot", "shard"),
) -> DataFrame:
    """All rows and columns, with the slot and the shard number of each row.

    Rows are not moved: the table has one row per slot, whatever the data, and is broadcast. A null key is placed
    by the column ``spare``, so that many null keys spread; if both are null, by the empty string. Equal keys
    meet in one shard. Columns of ``df`` named like ``out`` are replaced.
    """
    slot, shard = out
    table = df.sparkSession.createDataFrame(
        list(enumerate(fill_table(names, slots, weights))), f"`{slot}` int, `{shard}` int"
    )
    chosen = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("spare:"), F.col(spare).cast("string")), F.lit(""))
    rows = df.drop(shard).withColumn(slot, slot_of(chosen, slots))
    kept = [c for c in df.columns if c not in out]
    return rows.join(F.broadcast(table), slot).select(*kept, slot, shard)


def write_placed(df: DataFrame, path: str, shard: str = "shard", mode: str = "overwrite") -> None:
    """One folder per shard; the hint gathers a shard's rows and splits an outsized one into several files."""
    df.hint("rebalance", F.col(shard)).write.mode(mode).partitionBy(shard).parquet(path)
