"""Day dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repodw import fixed_values as V


def gen_dim_date(spark: SparkSession, start: str = V.CALENDAR_START, end: str = V.CALENDAR_END) -> DataFrame:
    """One row per day from start to end, both included."""
    span = spark.range(1).select(F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("last"))
    return calendar_of(span)


def calendar_of(span: DataFrame) -> DataFrame:
    """The day rows of a one-row frame (first, last). Weeks and weekdays are ISO: 1 is Monday, 7 Sunday."""
    day = F.col("date_id")
    weekday: Column = F.weekday(day) + 1
    days = span.select(F.explode(F.sequence("first", "last")).alias("date_id"))
    return days.select(
        "date_id",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.when(weekday >= 6, 1).otherwise(0).alias("is_weekend"),
    )
