"""A result kept in its order: any page is one read of a range of row numbers, and a keyword reads only ranges that can hold it.

`in_order` deals the rows into ranges of their order and numbers them there; `ranges_of` counts the ranges, which gives
every row its number in the whole; `grams_of` lists which three-letter grams occur in which range. All are computed once,
when the result is published; afterwards nothing is sorted or shuffled for a page.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repodw.operators.paging import Order

GRAM = 3


def in_order(df: DataFrame, order: Order) -> DataFrame:
    """The rows with range_no and place (from 0) in that range. To be written at once: a second computation may deal
    otherwise."""
    keys = [F.col(c).asc() if up else F.col(c).desc() for c, up in order]
    # The id counts a task's rows below its 33rd bit, and tasks above it.
    row = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id())
    return row.withColumns({
        "range_no": F.shiftright("_row", 33).cast("int"), "place": F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_row")


def ranges_of(rows: DataFrame) -> DataFrame:
    """range_no, before and rows: how many rows stand before a range, and in it. One row a range."""
    counts = sorted((r["range_no"], r["n"]) for r in rows.groupBy("range_no").agg(F.count(F.lit(1)).alias("n")).collect())
    found, before = [], 0
    for number, n in counts:
        found.append((number, before, n))
        before += n
    return rows.sparkSession.createDataFrame(found, "range_no int, before long, rows long")


def numbered(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """The rows of in_order with row_no, from 1, instead of place."""
    joined = rows.join(F.broadcast(ranges.select("range_no", "before")), "range_no")
    return joined.withColumn("row_no", F.col("before") + F.col("place") + 1).drop("before", "place")


def page_of(rows: DataFrame, ranges: DataFrame, page: int, size: int) -> DataFrame:
    """One page with row_no, total_rows and total_pages, as paging.page_rows gives it: the ranges' counts say which ranges
    hold its row numbers, and only these are read."""
    counts = ranges.select("range_no", "before", "rows").collect()
    total = sum(r["rows"] for r in counts)
    pages = max(1, -(-total // size))
    first = (min(max(1, page), pages) - 1) * size
    touched = [r["range_no"] for r in counts if r["before"] < first + size and r["before"] + r["rows"] > first]
    return (
        rows.filter(F.col("range_no").isin(touched) & F.col("row_no").between(first + 1, first + size)).orderBy("row_no").limit(size)
        .drop("range_no").withColumn("row_no", F.col("row_no").cast("int"))
        .withColumn("total_rows", F.lit(total).cast("long")).withColumn("total_pages", F.lit(pages).cast("long"))
    )


def _grams(text: Column) -> Column:
    """Runs of GRAM characters; a shorter text is its own."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (GRAM - 1), F.lit(1)))
    return F.transform(starts, lambda i: F.substr(text, i, F.lit(GRAM)))


def grams_of(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """gram, range_no: the distinct grams of the lower-cased columns in each range."""
    each = F.flatten(F.array(*[_grams(F.lower(F.coalesce(F.col(c), F.lit("")))) for c in columns]))
    return rows.select(F.explode(F.array_distinct(each)).alias("gram"), "range_no").distinct()


def literal_runs(keyword: str) -> list[str]:
    """The runs of literal characters in LIKE %keyword%: between its wildcards, a backslash taking the next character."""
    runs = [""]
    for escaped, wildcard, plain in re.findall(r"\\(.)|([%_])|(.)", f"{keyword}%", re.DOTALL):
        if wildcard:
            runs.append("")
        runs[-1] += escaped + plain
    return [run for run in runs if run]


def ranges_with(grams: DataFrame, runs: Sequence[str]) -> list[int]:
    """The ranges in which all the runs (ignoring case) may occur: those that hold every gram of each."""
    wanted: Column | None = None
    needed: list[Column] = []
    for run in {r.lower() for r in runs if r}:
        if len(run) < GRAM:
            needed.append(F.max(F.contains("gram", F.lit(run))))
            here = F.contains(F.col("gram"), F.lit(run))
        else:
            mine = sorted({run[k:k + GRAM] for k in range(len(run) - GRAM + 1)})
            needed.append(F.count_distinct(F.when(F.col("gram").isin(mine), F.col("gram"))) == len(mine))
            here = F.col("gram").isin(mine)
        wanted = here if wanted is None else wanted | here
    if wanted is None:
        return sorted(r["range_no"] for r in grams.select("range_no").distinct().collect())
    all_of = F.lit(True)
    for one in needed:
        all_of = all_of & one
    # One row a range at most.
    return sorted(r["range_no"] for r in grams.filter(wanted).groupBy("range_no").agg(all_of.alias("ok")).filter("ok").collect())
