"""CSV export of the newest detail rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repodw import fixed_values as V
from repodw.operators.filters import keyword_like
from repodw.operators.latest import latest_snapshot

BOM = "﻿"


def export_rows(fact: DataFrame, dim: DataFrame, keyword: str | None = None) -> DataFrame:
    """Newest detail rows under the export header, most starred first."""
    day = latest_snapshot(fact).withColumnRenamed("source_platform", "fact_platform")
    rows = day.join(dim.select("project_id", "full_name", "language", "source_platform"), "project_id")
    rows = keyword_like(rows, ["full_name", "org_name", "language"], keyword)
    source = ["full_name", "org_name", "language", "source_platform", "stars_count", "forks_count",
              "watchers_count", "open_issues_count", "snapshot_date"]
    return rows.orderBy(F.col("stars_count").desc(), "project_id").select(
        *[F.col(c).alias(title) for c, title in zip(source, V.EXPORT_HEADER)]
    )


def write_csv(rows: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header and a UTF-8 mark in front of it, so that spreadsheets read the text right.

    `single_file` gathers everything in one task; leave it off for anything large.
    """
    first = rows.columns[0]
    out = rows.withColumnRenamed(first, BOM + first)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", "true").csv(path)
