"""Newest-day filters.

The newest value is looked up first, as a one-row job, and then used as a literal: the planner prunes
partitions and sizes joins before the query runs, and the filter is pushed into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class NoRows(ValueError):
    """There is no newest value because the table is empty."""


def newest_value(df: DataFrame, column: str):
    """Greatest value of a column, None without rows."""
    return df.agg(F.max(column)).first()[0]


def rows_on(df: DataFrame, column: str, value) -> DataFrame:
    """Rows of one day; without a day, none."""
    return df.filter(F.col(column) == F.lit(value)) if value is not None else df.limit(0)


def latest_rows(df: DataFrame, column: str) -> DataFrame:
    return rows_on(df, column, newest_value(df, column))


def latest_partition(ods: DataFrame) -> DataFrame:
    """Raw-layer rows of the newest load day. An empty table is an error, because the star schema needs one."""
    day = newest_value(ods, "dt")
    if day is None:
        raise NoRows("the raw layer is empty; load a day first")
    return rows_on(ods, "dt", day)


def latest_snapshot(fact: DataFrame) -> DataFrame:
    """Facts of the newest day that has data (not of today). An empty table gives no rows."""
    return latest_rows(fact, "snapshot_date")


def latest_stat(mart: DataFrame) -> DataFrame:
    return latest_rows(mart, "stat_date")


def latest_row(mart: DataFrame, column: str = "stat_date") -> DataFrame:
    """The newest single row."""
    return mart.orderBy(F.col(column).desc()).limit(1)
