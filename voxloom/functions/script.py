"""Simplified / traditional script test and conversion over a supplied lookup table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Han code points assigned so far are below this, so a one-to-one table cannot be larger.
MAX_TABLE = 110_000

Pairs = Iterable[tuple[str, str]] | DataFrame


def table_strings(table: Pairs) -> tuple[str, str]:
    """The table as two strings of equal length for ``translate``."""
    if isinstance(table, DataFrame):
        rows = table.select("simplified", "traditional").orderBy("simplified").limit(MAX_TABLE + 1).collect()
        if len(rows) > MAX_TABLE:
            raise ValueError(f"script table has more than {MAX_TABLE} rows")
        table = [(r[0], r[1]) for r in rows]
    pairs = [(s, t) for s, t in table if s != t]
    if any(len(s) != 1 or len(t) != 1 for s, t in pairs):
        raise ValueError("script table must map one character to one character")
    return "".join(s for s, _ in pairs), "".join(t for _, t in pairs)


def is_script(c: Column, table: Pairs) -> Column:
    """True for Han text with no character used only in the traditional script."""
    simplified, traditional = table_strings(table)
    return is_han_without(c, "".join(dict.fromkeys(ch for ch in traditional if ch not in set(simplified))))


def is_han_without(c: Column, others: str) -> Column:
    """True for Han text that has none of the characters ``others``."""
    untouched = F.length(F.translate(c, others, "")) == F.length(c)
    return c.rlike(r"\p{IsHan}") & untouched


def convert_text(c: Column, table: Pairs) -> Column:
    simplified, traditional = table_strings(table)
    return F.translate(c, simplified, traditional)
