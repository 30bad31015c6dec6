"""Raw-layer rows to the star schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repodw import fixed_values as V
from repodw.functions.text import parse_created_at
from repodw.operators.dedup import keep_one
from repodw.operators.keyed import unseen, upsert


def project_rows(ods_day: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Project dimension rows of one load day, one per project; or of several, one per project and value of `by`.

    A project id found on two platforms keeps the row of the greater platform name.
    """
    ties = [F.col("source_platform").desc(), F.col("full_name"), F.col("org")]
    one = keep_one(ods_day, ["repo_id", *by], ties)
    return one.select(*by,
        F.col("repo_id").alias("project_id"),
        F.col("name").alias("project_name"),
        "full_name", "description", "language", "topics", "license_type", "html_url", "source_platform",
        parse_created_at(F.col("created_at")).alias("created_at"),
    )


def scd1_project(dim: DataFrame, ods_day: DataFrame) -> DataFrame:
    """The project dimension overwritten by the rows of a load day; other projects stay."""
    return upsert(dim, project_rows(ods_day), ["project_id"])


def last_rows(per_day: DataFrame, late: Sequence[str] = ()) -> DataFrame:
    """One row per project of project_rows by day (dt): the newest, or of days that come `late`, with older attributes,
    the first; `late` says which."""
    behind = F.col("dt").isin(list(late)) if late else F.lit(False)
    order = [F.col("late"), F.when(F.col("late"), F.col("dt")), F.col("dt").desc()]
    return keep_one(per_day.withColumn("late", behind), ["project_id"], order).drop("dt")


def changed_projects(dim: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of last_rows that change the dimension, with etl_time unset: projects it lacks, and others of which a
    column differs; late rows only add projects. `restate` marks those whose language or platform changed, with what
    they were before (`old_language`, `old_platform`)."""
    old, new = dim.alias("old"), rows.alias("new")
    columns = [c for c in dim.columns if c not in ("project_id", "etl_time")]
    differs = ~reduce(and_, [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in columns])
    moved = ~(F.col("new.language").eqNullSafe(F.col("old.language")) & F.col("new.source_platform").eqNullSafe(
        F.col("old.source_platform")))
    known = F.col("old.etl_time").isNotNull()
    return new.join(old, "project_id", "left").filter(~known | ~F.col("new.late") & differs).select(
        "project_id", *[F.col(f"new.{c}").alias(c) for c in columns], (known & moved).alias("restate"),
        F.col("old.language").alias("old_language"), F.col("old.source_platform").alias("old_platform"))


def distinct_orgs(ods_day: DataFrame, collation: str | None = None) -> DataFrame:
    """(organisation, platform) pairs of the load days given. With a collation, names equal under it count once, under
    the first day's smallest spelling."""
    pairs = ods_day.select(F.col("org").alias("org_name"), "source_platform", *(["dt"] if "dt" in ods_day.columns else []))
    if collation is None:
        return pairs.select("org_name", "source_platform").distinct()
    first = F.struct(*[c for c in ("dt", "org_name") if c in pairs.columns])
    key = F.collate(F.col("org_name"), collation)
    return pairs.groupBy(key.alias("_key"), "source_platform").agg(F.min_by("org_name", first).alias("org_name")).select(
        "org_name", "source_platform"
    )


def one_platform_name(ods: DataFrame, collation: str | None) -> DataFrame:
    """The rows with platforms that equal a known one under the collation written like it."""
    if collation is None:
        return ods
    name = F.col("source_platform")
    for known in (*V.WATCHED_ORGS, V.UNKNOWN_PLATFORM):
        name = F.when(F.collate(F.col("source_platform"), collation) == F.lit(known), F.lit(known)).otherwise(name)
    return ods.withColumn("source_platform", name)


def one_org_name(ods: DataFrame, dim_org: DataFrame, collation: str | None) -> DataFrame:
    """The rows with every organisation named as the dimension first had it."""
    if collation is None:
        return ods
    names = dim_org.groupBy(F.collate(F.col("org_name"), collation).alias("_key")).agg(
        F.min_by("org_name", F.struct("etl_time", "org_name")).alias("_name"))
    return ods.join(names, F.collate(ods["org"], collation) == names["_key"], "left").withColumn("org", F.coalesce("_name", "org")).drop("_key", "_name")


def new_orgs(dim_org: DataFrame, ods_day: DataFrame) -> DataFrame:
    """Organisations of a load day the dimension does not have yet."""
    return unseen(dim_org, distinct_orgs(ods_day), ["org_name", "source_platform"])


def fact_rows(ods_day: DataFrame) -> DataFrame:
    """The day's snapshot facts."""
    return ods_day.select(
        F.col("repo_id").alias("project_id"),
        F.col("org").alias("org_name"),
        "source_platform",
        F.col("dt").cast("date").alias("snapshot_date"),
        "stars_count", "forks_count", "watchers_count", "open_issues_count", "dt",
    )
