"""Shares of a total and scales of a small selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repodw.functions.numbers import percent


def share_of_total(df: DataFrame, measure: str, name: str, total: Column | None = None) -> DataFrame:
    """100 * measure / sum of the measure at two places, null when the total is 0.

    The total is a scalar subquery, so no window gathers the rows in one partition. Pass `total` when it is
    cheaper to take from somewhere else.
    """
    if total is None:
        total = df.agg(F.sum(measure).alias("total")).scalar()
    return df.withColumn(name, percent(F.col(measure), total))


def selection_total(measure: str) -> Column:
    """Total of a measure over a frame already cut to a handful of rows (the window is global)."""
    return F.sum(measure).over(Window.partitionBy())


def relative_to_max(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Per measure the axis bound max(1, max) and the value relative to it, for a handful of selected rows."""
    everything = Window.partitionBy()
    values = {m: F.coalesce(F.col(m), F.lit(0)) for m in measures}
    bounds = {m: F.greatest(F.lit(1), F.max(values[m]).over(everything)).cast("long") for m in measures}
    bounded = df.withColumns({f"{m}_max": bounds[m] for m in measures})
    return bounded.withColumns({f"{m}_scaled": values[m].cast("double") / F.col(f"{m}_max") for m in measures})
