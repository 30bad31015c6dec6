"""Daily rollups of the facts.

Every rollup first reduces the facts to one row per project and day (or organisation, project and day), so
that distinct counts become plain counts and a project with many fact rows reaches the joins as few. To
refresh some days only, pass facts of those days; `previous` days for the deltas are the caller's to include.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repodw.functions.numbers import ratio
from repodw.operators.delta import daily_with_delta


def project_daily(fact: DataFrame) -> DataFrame:
    """Per project and day the totals and their change since the day before."""
    rows = daily_with_delta(
        fact, ["project_id"], "snapshot_date",
        {"stars_count": "curr_day_new_stars", "forks_count": "curr_day_new_forks",
         "open_issues_count": "curr_day_new_issues"},
        keep=["stars_count", "forks_count"],
    )
    return rows.withColumnsRenamed({"stars_count": "total_cum_stars", "forks_count": "total_cum_forks"})


def with_day_before(fact: DataFrame, day: date) -> DataFrame:
    """Facts of a day and of the one before: all that the day's changes need."""
    return fact.filter(F.col("snapshot_date").between(day - timedelta(1), day))


def project_daily_on(fact: DataFrame, day: date) -> DataFrame:
    """project_daily of a single day."""
    return project_daily(with_day_before(fact, day)).filter(F.col("snapshot_date") == day)


def attribute_daily(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Counts per (language, platform, day): the small cube both language_daily and platform_daily add up.

    History is counted under the current dimension row. Facts without a dimension row are left out.
    """
    joined = _project_days(fact).join(dim.select("project_id", "language", "source_platform"), "project_id")
    return add_up(joined)


_CUBE = ["projects", "stars", "starred", "forks", "active"]


def _project_days(fact: DataFrame) -> DataFrame:
    return fact.groupBy("project_id", "snapshot_date").agg(
        F.lit(1).cast("long").alias("projects"),
        F.coalesce(F.sum(F.col("stars_count").cast("long")), F.lit(0)).alias("stars"),
        F.count("stars_count").alias("starred"),
        F.coalesce(F.sum(F.col("forks_count").cast("long")), F.lit(0)).alias("forks"),
        F.max(F.when(F.col("open_issues_count") > 0, 1).otherwise(0)).cast("long").alias("active"),
    )


def add_up(cube_rows: DataFrame) -> DataFrame:
    """Cube rows summed per (language, platform, day); groups without projects vanish."""
    sums = cube_rows.groupBy("language", "source_platform", "snapshot_date").agg(*[F.sum(c).alias(c) for c in _CUBE])
    return sums.filter("projects > 0")


def attribute_moves(fact: DataFrame, moved: DataFrame) -> DataFrame:
    """Cube rows that move projects from their old language and platform (`old_language`, `old_platform`) to
    the present ones: negative counts there, positive ones here. Reads the facts of these projects only."""
    days = _project_days(fact.join(moved.select("project_id"), "project_id", "left_semi"))
    sides = F.explode(F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("old_language").alias("language"), F.col("old_platform").alias("source_platform")),
        F.struct(F.lit(1).alias("sign"), "language", "source_platform"),
    ))
    both = moved.select("project_id", sides.alias("side")).select("project_id", "side.*")
    rows = days.join(both, "project_id")
    return rows.groupBy("language", "source_platform", "snapshot_date").agg(
        *[F.sum(F.col(c) * F.col("sign")).alias(c) for c in _CUBE]
    )


def language_daily(fact: DataFrame, dim: DataFrame, collation: str | None = None) -> DataFrame:
    return language_of(attribute_daily(fact, dim), collation)


def language_of(cube: DataFrame, collation: str | None = None) -> DataFrame:
    """Per language and day: projects, stars, forks, average stars. With a collation, languages equal under
    it are one group, named by the smallest spelling."""
    if collation is None:
        groups, name = ["language"], []
    else:
        cube = cube.withColumn("_key", F.collate(F.col("language"), collation))
        groups, name = ["_key"], [F.min("language").alias("language")]
    totals = cube.groupBy(*groups, "snapshot_date").agg(
        *name,
        F.sum("projects").alias("repo_count"),
        F.sum("stars").alias("total_stars"),
        F.sum("forks").alias("total_forks"),
        F.sum("starred").alias("starred"),
    )
    return totals.select("language", "snapshot_date", "repo_count", "total_stars", "total_forks",
                         ratio(F.col("total_stars"), F.col("starred")).alias("avg_stars"))


def platform_daily(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return platform_of(attribute_daily(fact, dim))


def platform_of(cube: DataFrame) -> DataFrame:
    """Per platform of the dimension and day: projects, stars, projects with open issues."""
    return cube.groupBy("source_platform", "snapshot_date").agg(
        F.sum("projects").alias("repo_count"),
        F.sum("stars").alias("total_stars"),
        F.sum("active").alias("active_projects"),
    )


def org_totals(fact: DataFrame, collation: str | None = None) -> DataFrame:
    """Per organisation name and day: projects, stars, forks. Platforms with the same name merge."""
    org = F.col("org_name")
    if collation is not None:
        fact = fact.withColumn("_key", F.collate(org, collation))
    by = "_key" if collation is not None else "org_name"
    per_project = fact.groupBy(by, "snapshot_date", "project_id").agg(
        *([F.min("org_name").alias("org_name")] if collation is not None else []),
        F.sum(F.col("stars_count").cast("long")).alias("stars"),
        F.sum(F.col("forks_count").cast("long")).alias("forks"),
    )
    totals = per_project.groupBy(by, "snapshot_date").agg(
        *([F.min("org_name").alias("org_name")] if collation is not None else []),
        F.count("project_id").alias("repo_count"),
        F.sum("stars").alias("total_stars"),
        F.sum("forks").alias("total_forks"),
    )
    return totals.select("org_name", "snapshot_date", "repo_count", "total_stars", "total_forks")


def org_daily(fact: DataFrame, collation: str | None = None) -> DataFrame:
    """org_totals with the change in repositories since the day before."""
    return org_delta(org_totals(fact, collation))


def org_delta(totals: DataFrame) -> DataFrame:
    return daily_with_delta(
        totals, ["org_name"], "snapshot_date", {"repo_count": "curr_day_new_repos"},
        carry=["total_stars", "total_forks"],
    ).select("org_name", "snapshot_date", "repo_count", "total_stars", "total_forks", "curr_day_new_repos")
