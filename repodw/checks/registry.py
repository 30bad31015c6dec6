"""Collects the queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from repodw.functions.numbers import wire_form

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, binding: type, sql: str | None = None):
    """Register a function of a binding as a query; its result leaves in wire form, as the SQL's does."""

    def register(function: Callable[..., DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return wire_form(function(binding(spark, folder)))

        run.__name__, run.__doc__ = name, function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def sql_ratio(top: str, bottom: str) -> str:
    """top / bottom of whole numbers, at least 0, half-up at two places, in whole-number arithmetic."""
    return (
        f"(CASE WHEN ({bottom}) = 0 THEN NULL ELSE "
        f"CAST((200 * CAST(({top}) AS HUGEINT) + ({bottom})) // (2 * ({bottom})) AS DOUBLE) / CAST(100 AS DOUBLE) END)"
    )


def sql_day(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"
