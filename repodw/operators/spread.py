"""Rows dealt over as many tasks as they need."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Spark leaves an aggregation as many partitions as the session names, and joins them to 64 MB of compressed rows: millions
# of narrow ones, for which each hash table of a task takes hundreds of MB.
ROWS_PER_TASK = 1 << 18


def parts_for(table: DataFrame) -> int:
    """Partitions for the rows of a stored table, whose count is read from the files' footers."""
    return max(table.sparkSession.sparkContext.defaultParallelism, -(-table.count() // ROWS_PER_TASK))


def spread(rows: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """The rows hashed by their keys into so many partitions; without a number, left as they are."""
    return rows if parts is None else rows.repartition(parts, *keys)
