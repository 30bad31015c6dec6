"""Ordered deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], keep: str = "first") -> DataFrame:
    """The first (or last) row per key in the given order; null keys equal each other.

    The rank filter is planned with a WindowGroupLimit on both sides of the shuffle, so every task sends at
    most one row per key and a key holding most of the rows costs no more than any other.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be first or last, not {keep}")
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    if keep == "last":
        order = [o.desc() for o in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def union_phases(first: DataFrame, second: DataFrame) -> DataFrame:
    """Append a second collection phase, remembering which came first."""
    return first.withColumn("phase", F.lit(1)).unionByName(
        second.withColumn("phase", F.lit(2)), allowMissingColumns=True
    )


def dedup_phases(phases: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First-seen row per key over collection phases in their order (say resumed rows, organisation results,
    search results), within a phase in the given order."""
    stacked = phases[0].withColumn("_phase", F.lit(0))
    for number, phase in enumerate(phases[1:], start=1):
        stacked = stacked.unionByName(phase.withColumn("_phase", F.lit(number)), allowMissingColumns=True)
    return keep_one(stacked, keys, ["_phase", *order]).drop("_phase")
