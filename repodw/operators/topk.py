"""Top-k and fold-the-rest. `orderBy().limit(k)` plans as TakeOrderedAndProject: k rows per task, never a sort
of everything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repodw import fixed_values as V


def top_rows(df: DataFrame, measure: str, count: int, ties: Sequence[str]) -> DataFrame:
    """The `count` highest rows by a measure, ties settled by the named columns."""
    return df.orderBy(F.col(measure).desc(), *ties).limit(count)


def pinned(df: DataFrame, count: int, key: str) -> tuple[DataFrame, list]:
    """A frame of at most `count` rows as a local relation, and its keys: computed once, then used for lookups."""
    rows = df.limit(count).collect()
    return df.sparkSession.createDataFrame(rows, df.schema), [row[key] for row in rows]


def numbered(df: DataFrame, measure: str, ties: Sequence[str], name: str, offset: int = 0) -> DataFrame:
    """Add 1, 2, 3 … in that order. Only for frames already cut to a few rows: the window is global."""
    order = Window.orderBy(F.col(measure).desc(), *[F.col(t) for t in ties])
    return df.withColumn(name, F.row_number().over(order) + F.lit(offset))


def top_and_rest(df: DataFrame, label: str, order_by: str, sums: Sequence[str],
                 count: int = V.FOLD_AFTER, rest: str = V.REST_LABEL, ties: Sequence[str] = ()) -> DataFrame:
    """The first `count` rows by `order_by`, all others summed into one `rest` row.

    Equal measures are ordered by `ties`, then by label; together they must tell all rows apart. A scalar
    subquery finds the sort key of the last row kept; the frame is then grouped into at most count + 1
    groups. There is no rest row when nothing is left over.
    """
    place = F.struct((-F.coalesce(F.col(order_by), F.lit(0)).cast("long")).alias("m"),
                     *ties, F.coalesce(F.col(label), F.lit("")).alias("l"))
    last_kept = (
        df.select(place.alias("place")).orderBy("place").limit(count).agg(F.max("place").alias("place")).scalar()
    )
    kept = place <= last_kept
    return (
        df.select(F.when(kept, place).alias("_place"),
                  F.when(kept, F.col(label)).otherwise(F.lit(rest)).alias(label), *sums)
        .groupBy("_place", label)
        .agg(*[F.sum(F.coalesce(F.col(s), F.lit(0))).alias(s) for s in sums])
        .drop("_place")
    )
