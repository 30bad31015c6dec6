"""Application marts of one day (`stat_date`), and the monthly trend."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repodw import fixed_values as V
from repodw.functions.numbers import count_if, ratio
from repodw.functions.text import month_of_date, month_of_text, not_blank
from repodw.operators.dedup import keep_one
from repodw.operators.latest import rows_on
from repodw.operators.shares import share_of_total
from repodw.operators.spread import spread
from repodw.operators.topk import numbered, pinned, top_rows


def on_day(df: DataFrame, day: date) -> DataFrame:
    return rows_on(df, "snapshot_date", day)


def dim_left_fact(dim: DataFrame, fact: DataFrame, day: date) -> DataFrame:
    """All projects with their facts of one day; projects without a fact that day stay, with nulls."""
    facts = on_day(fact, day).drop("source_platform")
    return dim.join(facts, "project_id", "left")


def overview(dim: DataFrame, fact: DataFrame, stat_date: date) -> DataFrame:
    """One row: all projects, and the stars, forks and organisations of the day.

    Projects are counted on the dimension alone, measures on the facts of known projects, so that a single
    narrow join serves what reads like an outer join with distinct counts.
    """
    per_org = on_day(fact, stat_date).join(dim.select("project_id"), "project_id", "left_semi").groupBy("org_name").agg(
        F.sum(F.col("stars_count").cast("long")).alias("stars"),
        F.count("stars_count").alias("starred"),
        F.sum(F.col("forks_count").cast("long")).alias("forks"),
    )
    measures = per_org.agg(F.struct(
        F.coalesce(F.sum("stars"), F.lit(0)).alias("stars"),
        F.coalesce(F.sum("forks"), F.lit(0)).alias("forks"),
        F.coalesce(F.sum("starred"), F.lit(0)).alias("starred"),
        F.count("org_name").alias("orgs"),
    ).alias("day"))
    totals = dim.agg(
        F.count(F.lit(1)).alias("total_repos"),
        count_if(F.col("source_platform") == "gitee").alias("gitee_repos"),
        count_if(F.col("source_platform") == "github").alias("github_repos"),
    ).withColumn("day", measures.scalar())
    average = F.coalesce(ratio(F.col("day.stars"), F.col("day.starred")), F.lit(0).cast("decimal(10,2)"))
    return totals.select(
        F.lit(stat_date).alias("stat_date"), "total_repos", F.col("day.stars").alias("total_stars"),
        F.col("day.forks").alias("total_forks"), F.col("day.orgs").alias("total_orgs"), "gitee_repos", "github_repos",
        average.alias("avg_stars"),
    )


def project_ranking(daily: DataFrame, dim: DataFrame, fact: DataFrame, stat_date: date,
                    rows: int = V.RANKING_ROWS) -> DataFrame:
    """The most starred projects of the day with their names and growth.

    The top rows are taken before any detail is joined; only projects the dimension knows compete. Being at
    most `rows`, they are pinned, and dimension and facts are read for their ids alone, with the ids pushed
    into the scans.
    """
    known = on_day(daily, stat_date).join(dim.select("project_id"), "project_id", "left_semi")
    top, ids = pinned(top_rows(known, "total_cum_stars", rows, ["project_id"]), rows, "project_id")
    mine = F.col("project_id").isin(ids)
    named = dim.select("project_id", "project_name", "full_name", "language", "source_platform").filter(mine)
    orgs = on_day(fact, stat_date).select("project_id", "org_name").filter(mine)
    wide = named.join(F.broadcast(top), "project_id").join(orgs, "project_id", "left")
    cut = top_rows(wide, "total_cum_stars", rows, ["project_id", "org_name"])
    return numbered(cut, "total_cum_stars", ["project_id", "org_name"], "rank_num").select(
        F.col("snapshot_date").alias("stat_date"), "rank_num", "project_name", "full_name", "org_name", "language",
        F.col("total_cum_stars").alias("stars_count"), F.col("total_cum_forks").alias("forks_count"),
        F.col("curr_day_new_stars").alias("star_growth"), "source_platform",
    )


def language_dist(language_daily: DataFrame, stat_date: date, by: str = "stars") -> DataFrame:
    """Languages of the day with their share of all stars, or of all repositories (`by="repos"`)."""
    measure = {"stars": "total_stars", "repos": "repo_count"}[by]
    day = on_day(language_daily, stat_date)
    return share_of_total(day, measure, "pct_of_total").select(
        F.col("snapshot_date").alias("stat_date"), "language", "repo_count", "total_stars", "pct_of_total"
    )


def org_compare(org_daily: DataFrame, dim_org: DataFrame, stat_date: date) -> DataFrame:
    """Organisations of the day; active (100) when they gained repositories that day.

    An organisation on two platforms is named by the smaller one and stays a single row.
    """
    platform = dim_org.groupBy("org_name").agg(F.min("source_platform").alias("source_platform"))
    return on_day(org_daily, stat_date).join(platform, "org_name", "left").select(
        F.col("snapshot_date").alias("stat_date"),
        "org_name",
        F.coalesce("source_platform", F.lit(V.UNKNOWN_PLATFORM)).alias("source_platform"),
        "repo_count", "total_stars",
        ratio(F.col("total_stars"), F.col("repo_count")).alias("avg_stars"),
        F.when(F.col("curr_day_new_repos") > 0, 100).otherwise(0).cast("decimal(5,2)").alias("active_rate"),
    )


def platform_months(platform_daily: DataFrame) -> DataFrame:
    """Per month: active projects added up over days, and the stars of all platforms on its last snapshot day."""
    days = platform_daily.groupBy("snapshot_date").agg(
        F.sum("total_stars").alias("stars"), F.sum("active_projects").alias("active")
    )
    return days.groupBy(month_of_date(F.col("snapshot_date")).alias("stat_month")).agg(
        F.sum("active").alias("platform_active"), F.max_by("stars", "snapshot_date").alias("month_end_stars")
    )


def month_end_total(platform_daily: DataFrame) -> DataFrame:
    return platform_months(platform_daily).select("stat_month", F.col("month_end_stars").alias("cumulative_stars"))


def project_months(project_daily: DataFrame) -> DataFrame:
    """Per month: projects seen, stars gained, and the sum of each project's best total of the month.

    One pass by (month, project) serves all three.
    """
    per_project = project_daily.groupBy(
        month_of_date(F.col("snapshot_date")).alias("stat_month"), "project_id"
    ).agg(F.max("total_cum_stars").alias("best"), F.sum("curr_day_new_stars").alias("gained"))
    return per_project.groupBy("stat_month").agg(
        F.count("project_id").alias("active_projects"),
        F.sum("gained").alias("new_stars"),
        F.sum("best").alias("best_stars"),
    )


def project_month_rows(project_daily: DataFrame, sign: int = 1) -> DataFrame:
    """Per month and project: days, stars gained, best total. With sign -1, what to take away for rows that go."""
    month = month_of_date(F.col("snapshot_date")).alias("stat_month")
    return project_daily.groupBy(month, "project_id").agg(
        (F.lit(sign) * F.count(F.lit(1))).alias("days"),
        (F.lit(sign) * F.coalesce(F.sum(F.col("curr_day_new_stars").cast("long")), F.lit(0))).alias("gained"),
        F.max("total_cum_stars").alias("best"))


def project_month_update(state: DataFrame, came: DataFrame, went: DataFrame) -> DataFrame:
    """The state (project_month_rows) after some daily rows came and others went, both as project_month_rows. `open` marks
    those whose best total went with a day, so that only the month's other days can tell it."""
    parts = [rows.select("stat_month", "project_id", "days", "gained", *[
        F.col("best").alias(name) if k == own else F.lit(None).cast("int").alias(name) for k, name in enumerate(("was", "now", "gone"))])
        for own, rows in enumerate((state, came, went))]
    summed = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("stat_month", "project_id").agg(
        F.sum("days").alias("days"), F.sum("gained").alias("gained"), *[F.max(c).alias(c) for c in ("was", "now", "gone")])
    lost = (F.col("gone") >= F.col("was")) & (F.col("now").isNull() | (F.col("now") < F.col("was")))
    return summed.filter("days > 0").select(
        "stat_month", "project_id", "days", "gained", F.greatest("was", "now").alias("best"), F.coalesce(lost, F.lit(False)).alias("open"))


def day_sums(org_daily: DataFrame, platform_daily: DataFrame) -> DataFrame:
    """Per day: repositories organisations gained, active projects and stars of all platforms."""
    org = org_daily.groupBy("snapshot_date").agg(F.sum("curr_day_new_repos").alias("org_new_repos"))
    platform = platform_daily.groupBy("snapshot_date").agg(
        F.sum("active_projects").alias("platform_active"), F.sum("total_stars").alias("stars"))
    rows = org.join(platform, "snapshot_date", "full_outer")
    return rows.withColumn("stat_month", month_of_date(F.col("snapshot_date")))


def monthly_of(project_month: DataFrame, sums: DataFrame) -> DataFrame:
    """monthly() from the kept state: project_month_rows and day_sums."""
    projects = project_month.groupBy("stat_month").agg(
        F.count("project_id").alias("active_projects"), F.sum("gained").alias("new_stars"), F.sum(F.col("best").cast("long")).alias("best_stars"))
    newest = F.max_by("stars", F.when(F.col("stars").isNotNull(), F.col("snapshot_date")))
    days = sums.groupBy("stat_month").agg(
        F.sum("org_new_repos").alias("org_new_repos"), F.sum("platform_active").alias("platform_active"), newest.alias("month_end_stars"))
    return projects.join(days, "stat_month", "left").select(
        "stat_month", *[F.coalesce(F.col(m).cast("long"), F.lit(0)).alias(m) for m in _MONTH_SUMS])


_MONTH_SUMS = ["org_new_repos", "platform_active", "new_stars", "month_end_stars", "active_projects", "best_stars"]


def monthly(project_daily: DataFrame, org_daily: DataFrame, platform_daily: DataFrame) -> DataFrame:
    """All month sums, over the months that have project snapshots; what a month lacks is 0.

    Instead of joining monthly aggregates to a month spine, the parts are stacked and added up by month once,
    each bringing the sums it has; a month is kept when the project part has it.
    """
    org = org_daily.groupBy(month_of_date(F.col("snapshot_date")).alias("stat_month")).agg(
        F.sum("curr_day_new_repos").alias("org_new_repos")
    )
    stacked = project_months(project_daily).withColumn("in_spine", F.lit(1))
    for part in (org, platform_months(platform_daily)):
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return (
        stacked.groupBy("stat_month")
        .agg(F.max("in_spine").alias("in_spine"),
             *[F.coalesce(F.sum(F.col(m).cast("long")), F.lit(0)).alias(m) for m in _MONTH_SUMS])
        .filter("in_spine = 1").select("stat_month", *_MONTH_SUMS)
    )


def monthly_once(fact: DataFrame, dim: DataFrame, parts: int | None = None) -> DataFrame:
    """monthly() of the facts themselves, which are read once.

    Facts are reduced to a row per project, organisation and day; grouping sets give rows per project and day and per
    organisation and day out of these. Change against the day before, and a month's sums of each project or organisation,
    are found in the one partitioning by these. The stars at a month's end are those of the projects whose last day in the
    month is the month's last, so that no further pass by day is needed. Facts of projects that `dim` lacks count for no
    platform. `parts` is the number of partitions the days of projects and organisations are dealt over.
    """
    stars = F.col("stars_count").cast("long")
    days = fact.groupBy("project_id", "org_name", "snapshot_date").agg(
        F.max("stars_count").alias("best"), F.sum(stars).alias("stars"), F.max(F.col("open_issues_count") > 0).alias("open"))
    sets = days.groupingSets([["project_id", "snapshot_date"], ["org_name", "snapshot_date"]], "project_id", "org_name", "snapshot_date").agg(
        (F.grouping("org_name") == 1).alias("is_project"), F.max("best").alias("best"), F.sum("stars").alias("stars"),
        F.max("open").alias("open"), F.count("project_id").alias("projects"))
    known = dim.select("project_id", F.lit(True).alias("known")).distinct()
    rows = sets.join(known, "project_id", "left").withColumn("value", F.when(F.col("is_project"), F.col("best")).otherwise(F.col("projects")))
    key = ["is_project", "project_id", "org_name"]
    rows = spread(rows, parts, *key)
    before = Window.partitionBy(*key).orderBy("snapshot_date")
    adjacent = F.lag("snapshot_date").over(before) == F.date_sub("snapshot_date", 1)
    change = F.col("value") - F.coalesce(F.when(adjacent, F.lag("value").over(before)), F.col("value"))
    counted = F.col("is_project") & F.coalesce("known", F.lit(False))
    per_key = rows.withColumn("change", change).groupBy(*key, month_of_date(F.col("snapshot_date")).alias("stat_month")).agg(
        F.max("value").alias("best"), F.sum("change").alias("change"), F.count(F.when(counted & F.col("open"), 1)).alias("active"),
        F.max(F.when(counted, F.struct("snapshot_date", F.coalesce("stars", F.lit(0)).alias("stars")))).alias("last"))
    project = F.col("is_project")
    per_day = per_key.groupBy("stat_month", F.col("last.snapshot_date").alias("last_day")).agg(
        F.count(F.when(project, F.col("project_id"))).alias("active_projects"), F.max(project).alias("in_spine"),
        F.sum(F.when(project, F.col("change"))).alias("new_stars"), F.sum(F.when(project, F.col("best"))).alias("best_stars"),
        F.sum(F.when(~project, F.col("change"))).alias("org_new_repos"), F.sum("active").alias("platform_active"),
        F.sum("last.stars").alias("last_stars"))
    added = ["org_new_repos", "platform_active", "new_stars", "active_projects", "best_stars"]
    months = per_day.groupBy("stat_month").agg(
        F.max("in_spine").alias("in_spine"), F.max_by("last_stars", "last_day").alias("month_end_stars"), *[F.sum(c).alias(c) for c in added])
    return months.filter("in_spine").select("stat_month", *[F.coalesce(F.col(m).cast("long"), F.lit(0)).alias(m) for m in _MONTH_SUMS])


def monthly_trend_snapshots(months: DataFrame) -> DataFrame:
    """Monthly trend over the months that have snapshots."""
    return months.select(
        "stat_month", F.col("org_new_repos").alias("new_repos"), F.col("platform_active").alias("active_repos"),
        "new_stars", F.col("month_end_stars").alias("cumulative_stars"),
    )


def created_by_month(ods: DataFrame, distinct_repos: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Repositories by the month they were created in (and by further columns). Every load day counts its
    rows, unless `distinct_repos` asks for each repository once."""
    rows = ods.filter(not_blank(F.col("created_at")))
    month = month_of_text(F.col("created_at")).alias("stat_month")
    if distinct_repos:
        rows = rows.select(month, "repo_id", "source_platform", *by).distinct()
        return rows.groupBy("stat_month", *by).agg(F.count(F.lit(1)).alias("new_repos"))
    return rows.groupBy(month, *by).agg(F.count(F.lit(1)).alias("new_repos"))


def monthly_trend_history(created: DataFrame, months: DataFrame) -> DataFrame:
    """Monthly trend over the months repositories were created in (rows of created_by_month, which may be
    split by load day), with the sums of project_months."""
    new = created.groupBy("stat_month").agg(F.sum("new_repos").alias("new_repos"))
    joined = new.join(months.select("stat_month", "active_projects", "new_stars", "best_stars"), "stat_month", "left")
    return joined.select("stat_month", "new_repos", *[
        F.coalesce(source, F.lit(0)).cast("long").alias(name) for source, name in
        {"active_projects": "active_repos", "new_stars": "new_stars", "best_stars": "cumulative_stars"}.items()
    ])


def monthly_trend_merged(snapshots: DataFrame, history: DataFrame) -> DataFrame:
    """Final trend: months of the history replace equal months of the snapshots.

    Both are small, and costlier to compute than to sort: each is read once.
    """
    stacked = snapshots.withColumn("source", F.lit(1)).unionByName(history.withColumn("source", F.lit(2)))
    return keep_one(stacked, ["stat_month"], ["source"], keep="last").drop("source")
