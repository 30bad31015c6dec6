"""Which repositories and units an ingest takes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repodw import fixed_values as V
from repodw.operators.dedup import dedup_phases


# Tasks whose best rows meet in one.
_PARTS = 64


def track_orgs(df: DataFrame, watched: Mapping[str, Sequence[str]] = V.WATCHED_ORGS, org: str = "org",
               platform: str = "source_platform") -> DataFrame:
    """Rows whose organisation is on the platform's watch list. The lists are literals, so the filter reaches
    the scan."""
    keep = F.lit(False)
    for name, orgs in watched.items():
        keep = keep | ((F.col(platform) == name) & F.col(org).isin(list(orgs)))
    return df.filter(keep)


def pending_units(targets: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Units still to be ingested: the targets without the ones already done."""
    return targets.join(done.select(*keys).distinct(), list(keys), "left_anti")


def resume(targets: DataFrame, done: DataFrame, collected: DataFrame, fresh: DataFrame, keys: Sequence[str],
           row_keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows collected before a break, then the fresh rows of the pending units; first seen wins."""
    pending = pending_units(targets, done, keys).select(*keys).distinct()
    return dedup_phases([collected, fresh.join(pending, list(keys), "left_semi")], row_keys, order)


def keyword_pick(df: DataFrame, keywords: Sequence[str] = tuple(V.SEARCH_KEYWORDS),
                 columns: Sequence[str] = ("name", "full_name", "description"), rows: int = V.SEARCH_ROWS_PER_KEYWORD,
                 stars: str = "stars_count", ties: Sequence[str] = ("repo_id",)) -> DataFrame:
    """Per keyword the best-starred repositories that mention it, at most `rows` of them.

    The keywords are tested inside the row, so only matches multiply. A common keyword's rows meet in a tree: every task
    sends on its best `rows`, those of _PARTS neighbouring tasks meet in one, the best of _PARTS such groups in one again,
    and then all; so a task gets _PARTS times `rows` at most until few groups are left, however many tasks there are.
    Whole rows are carried: each ranked row comes back once, whether its ties are null or repeated.
    """
    text = F.lower(F.concat_ws("\n", *[F.col(c) for c in columns]))
    hits = F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(text, F.lower(k)))
    order = [F.col(stars).desc(), *[F.col(t) for t in ties]]
    keyed = df.withColumn("_task", F.spark_partition_id()).withColumn("keyword", F.explode(hits))
    groups = [F.floor(F.col("_task") / size) for size in (_PARTS, _PARTS**2)]
    for by in [*groups, F.lit(0)]:
        rank = F.row_number().over(Window.partitionBy("keyword", by).orderBy(*order))
        keyed = keyed.withColumn("_rank", rank).filter(F.col("_rank") <= rows).drop("_rank")
    return keyed.drop("_task")
