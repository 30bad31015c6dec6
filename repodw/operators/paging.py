"""Page n of an ordered result, exact at any depth."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from repodw.session import written_for_now

Order = Sequence[tuple[str, bool]]  # (column, ascending); must order the rows totally


def page_rows(df: DataFrame, order: Order, page: int, size: int) -> DataFrame:
    """Rows of one page with `total_rows`, `total_pages` and a running `row_no`.

    A page past the end gives the last page. The same way at every depth: the keys alone are dealt into ranges and
    counted per range, which says in which range the page begins and how far into it; its first and last key are taken
    from there, and the rows between them are the page. No task gathers the rows before a page. This runs jobs and writes
    the keys while the query is built; for a result that is asked for many pages see operators/stored.py.
    """
    keys = [F.col(c).asc() if up else F.col(c).desc() for c, up in order]
    ranged = df.select(*[c for c, _ in order]).repartitionByRange(*keys).withColumn("_range", F.spark_partition_id())
    with written_for_now(ranged, "page") as parts:
        # One count per range, of which there are as many as shuffle partitions.
        counts = sorted((r["_range"], r["n"]) for r in parts.groupBy("_range").agg(F.count("*").alias("n")).collect())
        total = sum(n for _, n in counts)
        skip = (min(max(1, page), max(1, -(-total // size))) - 1) * size
        before, reached, touched = 0, 0, []
        for number, n in counts:
            if reached + n > skip and reached < skip + size:
                before = before if touched else reached
                touched.append(number)
            reached += n
        inside = parts.filter(F.col("_range").isin(touched)).drop("_range").orderBy(*keys)
        found = inside.offset(skip - before).limit(size).collect()
    rows = df.filter(F.lit(False))
    if found:
        rows = df.filter(~_precedes(found[0], order) & (_precedes(found[-1], order) | _equals(found[-1], order)))
    return (
        rows.orderBy(*keys).limit(size)
        .withColumn("row_no", F.row_number().over(Window.orderBy(*keys)) + F.lit(skip))
        .withColumn("total_rows", F.lit(total).cast("long"))
        .withColumn("total_pages", F.greatest(F.lit(1), F.ceil(F.col("total_rows") / size)).cast("long"))
    )


def _equals(key: Row, order: Order) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.lit(key[name])) for name, _ in order])


def _precedes(key: Row, order: Order) -> Column:
    """Whether a row comes strictly before `key`; nulls come first ascending and last descending."""
    cases: list[Column] = []
    equal = F.lit(True)
    for name, ascending in order:
        col, value = F.col(name), key[name]
        if value is None:
            here = F.lit(False) if ascending else col.isNotNull()
        elif ascending:
            here = col.isNull() | (col < F.lit(value))
        else:
            here = F.coalesce(col > F.lit(value), F.lit(False))
        cases.append(equal & here)
        equal = equal & col.eqNullSafe(F.lit(value))
    return reduce(lambda a, b: a | b, cases)
