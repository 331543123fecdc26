"""Number helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Multiplier that cuts a double into two halves of 26 bits, so their products are exact.
_SPLIT = float(2**27 + 1)


def py_round(c: Column, digits: int = 0) -> Column:
    """Round as Python does: half to even on the exact binary value of the double.

    ``round`` works on the shortest decimal text of the double and rounds halves away from zero, so
    0.0625 and 2.675 come out differently. Here ``x * 2 * 10^digits`` decides: only when that product
    is an odd integer is the value near a tie, and its exact rounding error tells the side.
    """
    scale = float(10**digits)
    twice = F.lit(2.0 * scale)
    x = F.abs(c.cast("double"))
    p = x * twice
    carry = x * F.lit(_SPLIT)
    high = carry - (carry - x)
    error = (high * twice - p) + (x - high) * twice
    half = F.lit(0.5)
    even = F.floor(p / 4.0).cast("double") * 2.0 + F.when(F.pmod(p, F.lit(4.0)) == 3.0, 2.0).otherwise(0.0)
    nearest = (
        F.when(F.pmod(p, F.lit(2.0)) != 1.0, F.floor((p + 1.0) * half).cast("double"))
        .when(error > 0, (p + 1.0) * half)
        .when(error < 0, (p - 1.0) * half)
        .otherwise(even)
    )
    return F.when(x < F.lit(2.0**52) / scale, F.signum(c) * nearest / scale).otherwise(c.cast("double"))


def is_number(c: Column) -> Column:
    """True for plain decimal or exponent notation, with blanks around it allowed."""
    return F.coalesce(c.rlike(r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"), F.lit(False))


def to_number(c: Column) -> Column:
    return F.when(is_number(c), F.trim(F.regexp_replace(c, r"\s", "")).try_cast("double"))


def safe_int(c: Column) -> Column:
    """Integer value of a text, null when it is none."""
    return F.when(c.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(c).try_cast("bigint"))


def unit_hash(*parts: Column | str | int) -> Column:
    """A repeatable number in [0, 1) drawn from the parts.

    Built on md5 so that any other engine can reproduce it.
    """
    return F.conv(F.substring(_digest(*parts), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_rank(*parts: Column | str | int) -> Column:
    """A repeatable integer of 60 bits to order rows by."""
    return F.conv(F.substring(_digest(*parts), 1, 15), 16, 10).cast("bigint")


def _digest(*parts: Column | str | int) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))
