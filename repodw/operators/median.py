"""Exact median of an INT measure without gathering its values in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_median(df: DataFrame, measure: str) -> Column:
    """Median as a scalar subquery (mean of the two middle values; null when there are none).

    Values are counted first, so repeats cost nothing. An INT splits into 65,536 blocks of 65,536 values: a
    running count over the blocks finds the block of each middle rank, and a running count inside those at
    most two blocks finds the value. Both windows are bounded by 131,072 rows whatever the size of the input.
    """
    counts = (
        df.filter(F.col(measure).isNotNull())
        .select(F.col(measure).cast("int").alias("v"))
        .groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("block", F.shiftright("v", 16))
    )
    blocks = counts.groupBy("block").agg(F.sum("n").alias("block_n"))
    # The two middle ranks are columns, not part of the aggregates: their subquery may hold anything the input does.
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")).scalar()
    ranks = {"low": F.floor((total + 1) / 2), "high": F.floor((total + 2) / 2)}
    upto = F.sum("block_n").over(Window.orderBy("block"))
    blocks = (
        blocks.withColumn("upto", upto).withColumns(ranks)
        .withColumn("before", F.col("upto") - F.col("block_n"))
        .filter(_holds("low", "before", "upto") | _holds("high", "before", "upto"))
        .select("block", "before", "low", "high")
    )
    # At most two blocks are left, so broadcasting them is bounded.
    inside = counts.join(F.broadcast(blocks), "block")
    inside = inside.withColumn("last", F.col("before") + F.sum("n").over(Window.partitionBy("block").orderBy("v")))
    inside = inside.withColumn("first", F.col("last") - F.col("n")).withColumn("value", F.col("v").cast("double"))
    middle = [F.max(F.when(_holds(rank, "first", "last"), F.col("value"))) for rank in ranks]
    return inside.agg(((middle[0] + middle[1]) / 2).alias("median")).scalar()


def _holds(rank: str, before: str, upto: str) -> Column:
    return (F.col(before) < F.col(rank)) & (F.col(rank) <= F.col(upto))
