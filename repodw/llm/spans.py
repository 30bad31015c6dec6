"""Matches of patterns in texts, with their places and neighbourhood, as columns.

Nulls and odd input: a null text has no matches. Rows that repeat doc_id (null or not) and text are one document, and
come out once; they are brought together ahead of the shuffle, so that a document may be repeated any number of times.
Rows that share an id and differ in text are documents of their own. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEAR = 32
_KEY = ["doc_id", "text_hash"]


def found(docs: DataFrame, patterns: dict[str, str], screens: dict[str, Column], near: int = NEAR, across: bool = False) -> DataFrame:
    """A row per match: doc_id, text_hash, kind, start, end (code points, end exclusive), value, before, after; and one
    with null kind for each document without any.

    Matches of a kind are leftmost and don't overlap. A text is only searched for a kind if its screen, a cheap
    condition that every match implies, holds. Only matches are shuffled, never texts. `before` and `after` hold `near`
    characters up to the matches beside; with `across`, `before` goes on into the match before.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    for kind, pattern in patterns.items():
        rows = rows.withColumn(f"_{kind}", F.when(screens[kind], F.struct(
            F.split("text", pattern, -1).alias("gaps"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("values"))))
    listed = [_listed(kind, near, across) for kind in patterns]
    rows = rows.withColumn("_found", F.concat(*listed))
    # A row per document: copies of it hold the same matches, whose places must not be added up twice.
    once = rows.groupBy(*_KEY).agg(F.first("_found").alias("_found"))
    each = once.select(*_KEY, F.explode_outer("_found").alias("m")).select(*_KEY, "m.*")
    upto = Window.partitionBy(*_KEY, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap").cast("long") + F.length("value")).over(upto)
    return each.withColumn("end", end).select(*_KEY, "kind", (F.col("end") - F.length("value")).alias("start"), "end", "value", "before", "after")


def _listed(kind: str, near: int, across: bool) -> Column:
    gaps, values = F.col(f"_{kind}.gaps"), F.col(f"_{kind}.values")

    def one(value: Column, i: Column) -> Column:
        lead = F.concat(F.coalesce(F.get(values, i - 1), F.lit("")), F.get(gaps, i)) if across else F.get(gaps, i)
        return F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(F.get(gaps, i)).alias("gap"), value.alias("value"),
            F.right(lead, F.lit(near)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(near)).alias("after"))

    empty = F.array().cast("array<struct<kind:string,i:int,gap:int,value:string,before:string,after:string>>")
    return F.coalesce(F.transform(values, one), empty)
