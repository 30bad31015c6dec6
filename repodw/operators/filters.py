"""Parameterised predicates of the serving queries."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def equals_filter(df: DataFrame, column: str, value: str | None, collation: str | None = None) -> DataFrame:
    """Rows equal to the trimmed value; a blank value selects nothing."""
    wanted = (value or "").strip()
    if not wanted:
        return df.limit(0)
    left = F.collate(F.col(column), collation) if collation else F.col(column)
    return df.filter(left == F.lit(wanted))


def keyword_like(df: DataFrame, columns: Sequence[str], keyword: str | None, literal: bool = False) -> DataFrame:
    """Any column LIKE %keyword%, ignoring case. In the keyword `%` and `_` are wildcards and a backslash takes
    the next character as it is, unless `literal`."""
    wanted = (keyword or "").strip()
    if not wanted:
        return df
    if literal:
        wanted = re.sub(r"([\\%_])", r"\\\1", wanted)
    # LIKE wants a backslash only where it changes something.
    pattern = re.sub(r"\\(.)", lambda m: m[0] if m[1] in "\\%_" else m[1], f"%{wanted}%")
    return df.filter(_any([F.col(c).ilike(pattern) for c in columns]))


def keyword_contains(df: DataFrame, columns: Sequence[str], keyword: str | None) -> DataFrame:
    """Any column contains the trimmed keyword literally, ignoring case; a blank keyword keeps every row."""
    wanted = (keyword or "").strip().lower()
    if not wanted:
        return df
    return df.filter(_any([F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(wanted)) for c in columns]))


def multi_select(df: DataFrame, platform: str | None, languages: Sequence[str] = (),
                 platform_column: str = "platform", language_column: str = "language") -> DataFrame:
    """Platform equals (blank: all) and language in the list (empty: all)."""
    if platform:
        df = df.filter(F.col(platform_column) == platform)
    if languages:
        df = df.filter(F.col(language_column).isin(list(languages)))
    return df


def action_and_keyword(log: DataFrame, action: str | None, keyword: str | None) -> DataFrame:
    """Audit rows of one action (blank: all) whose user or detail contains the keyword."""
    if action:
        log = log.filter(F.col("action") == action)
    return keyword_contains(log, ["username", "detail"], keyword)


def _any(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result
