"""Keyed writes as DataFrame algebra."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repodw.operators.dedup import keep_one


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updates win on a key collision, other target rows survive. Updates must be unique by key."""
    kept = target.join(updates.select(*keys), _null_safe(target, updates, keys), "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def unseen(target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str] = (), collation: str | None = None) -> DataFrame:
    """The rows whose key the target lacks, the first per key by `order`, then by all columns: what an insert-ignore adds.
    With a collation, text keys equal under it are the same key, and the target keeps its spelling."""
    others = [*order, *[c for c in rows.columns if c not in (*keys, *order)]]
    if collation:
        others += list(keys)
    first = keep_one(rows, [_compared(rows, k, collation) for k in keys], others)
    return first.join(target.select(*keys), _null_safe(first, target, keys, collation), "left_anti")


def _compared(df: DataFrame, key: str, collation: str | None) -> Column:
    return F.collate(df[key], collation) if collation and df.schema[key].dataType == T.StringType() else df[key]


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], collation: str | None = None):
    condition = F.lit(True)
    for key in keys:
        condition = condition & _compared(left, key, collation).eqNullSafe(_compared(right, key, collation))
    return condition
