"""Counts taken while data flows: stage counts and observed counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The same rows, with their count available after the next action: no second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_records"))


def stage_counts(df: DataFrame, stages: Sequence[tuple[str, Column]], by: Sequence[str] = ()) -> DataFrame:
    """Rows that survive each filter of a chain, in one aggregate.

    Gives (stage, position, n) where position 0 is the input.
    """
    passed: Column = F.lit(True)
    counts = [F.count("*").alias("s0")]
    for at, (_, keep) in enumerate(stages, 1):
        passed = passed & F.coalesce(keep, F.lit(False))
        counts.append(F.count_if(passed).alias(f"s{at}"))
    names = ["input", *(name for name, _ in stages)]
    wide = df.groupBy(*by).agg(*counts) if by else df.agg(*counts)
    rows = [F.struct(F.lit(n).alias("stage"), F.lit(i).alias("position"), F.col(f"s{i}").alias("n")) for i, n in enumerate(names)]
    return wide.select(*by, F.inline(F.array(*rows)))


def changed_rows(df: DataFrame, before: str, after: str) -> DataFrame:
    """How many rows a rewrite changed."""
    return df.agg(
        F.count("*").alias("n_rows"), F.count_if(~F.col(before).eqNullSafe(F.col(after))).alias("n_changed")
    )
