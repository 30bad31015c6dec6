"""Serving queries over the marts and the star schema. All return DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repodw import fixed_values as V
from repodw.functions.numbers import count_if, wire_form
from repodw.operators import filters, paging, shares, stored, topk
from repodw.operators.latest import latest_row, latest_snapshot, latest_stat

DETAIL_KEYWORD_COLUMNS = ["fullName", "orgName", "language"]
MEASURES = ["starsCount", "forksCount", "watchersCount", "openIssuesCount"]
DETAIL_ORDER = [("starsCount", False), ("projectId", True)]


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(source).alias(name) for source, name in names.items()])


def q_overview(ads_overview: DataFrame) -> DataFrame:
    return wire_form(_renamed(latest_row(ads_overview), {
        "stat_date": "statDate", "total_repos": "totalRepos", "total_stars": "totalStars",
        "total_forks": "totalForks", "avg_stars": "avgStars", "total_orgs": "totalOrgs",
        "gitee_repos": "giteeRepos", "github_repos": "githubRepos",
    }))


def q_ranking(ads_project_ranking: DataFrame) -> DataFrame:
    return _renamed(latest_stat(ads_project_ranking).orderBy("rank_num"), {
        "rank_num": "ranking", "project_name": "projectName", "full_name": "fullName", "org_name": "orgName",
        "language": "language", "stars_count": "starsCount", "forks_count": "forksCount",
        "star_growth": "starGrowth", "source_platform": "platform",
    })


def q_language(ads_language_dist: DataFrame) -> DataFrame:
    rows = latest_stat(ads_language_dist).orderBy(F.col("repo_count").desc(), "language")
    return wire_form(_renamed(rows, {
        "language": "language", "repo_count": "repoCount", "total_stars": "totalStars", "pct_of_total": "pctOfTotal",
    }))


def q_trend(ads_monthly_trend: DataFrame) -> DataFrame:
    return _renamed(ads_monthly_trend.orderBy("stat_month"), {
        "stat_month": "month", "new_repos": "newRepos", "active_repos": "activeRepos", "new_stars": "newStars",
        "cumulative_stars": "cumulativeStars",
    })


def q_org_compare(ads_org_compare: DataFrame) -> DataFrame:
    rows = latest_stat(ads_org_compare).orderBy(F.col("total_stars").desc(), "org_name")
    return wire_form(_renamed(rows, {
        "org_name": "orgName", "source_platform": "platform", "repo_count": "repoCount",
        "total_stars": "totalStars", "avg_stars": "avgStars", "active_rate": "activeRate",
    }))


def repo_details(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Detail rows of the newest day, unordered, with projectId to settle ties."""
    names = dim.select("project_id", "full_name", "language", F.col("source_platform").alias("platform"))
    day = latest_snapshot(fact).drop("source_platform")
    return wire_form(_renamed(day.join(names, "project_id"), {
        "project_id": "projectId", "full_name": "fullName", "language": "language", "platform": "platform",
        "org_name": "orgName", "stars_count": "starsCount", "forks_count": "forksCount",
        "watchers_count": "watchersCount", "open_issues_count": "openIssuesCount", "snapshot_date": "snapshotDate",
    }))


def q_org_repos(fact: DataFrame, dim: DataFrame, org: str | None, collation: str | None = None) -> DataFrame:
    """Drill-down: repositories of one organisation on the newest day of all facts."""
    rows = filters.equals_filter(repo_details(fact, dim), "orgName", org, collation)
    return rows.orderBy(F.col("starsCount").desc(), "projectId").select(
        "fullName", "language", "platform", "starsCount", "forksCount", "watchersCount", "snapshotDate"
    )


def q_repos(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return repo_details(fact, dim).orderBy(F.col("starsCount").desc(), "projectId").drop("projectId")


def q_search_page(fact: DataFrame, dim: DataFrame, keyword: str | None, page: int = 1, size: int = 10) -> DataFrame:
    """One page of the detail rows that contain the keyword."""
    found = filters.keyword_contains(repo_details(fact, dim), DETAIL_KEYWORD_COLUMNS, keyword)
    return paging.page_rows(found, DETAIL_ORDER, page, size).drop("projectId")


def kept_details(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """The detail rows dealt into ranges of their order (stored.in_order)."""
    return stored.in_order(repo_details(fact, dim), DETAIL_ORDER)


def kept_search_page(details: DataFrame, ranges: DataFrame, grams: DataFrame, keyword: str | None, page: int = 1,
                     size: int = 10) -> DataFrame:
    """q_search_page on the kept detail rows. Without a keyword a page is a read of its row numbers; with one, only the
    ranges that hold all its grams are read, and their rows tested."""
    wanted = (keyword or "").strip()
    if not wanted:
        return stored.page_of(details, ranges, page, size).drop("projectId")
    found = filters.keyword_contains(kept_with(details, grams, [wanted]), DETAIL_KEYWORD_COLUMNS, wanted)
    return paging.page_rows(found.drop("row_no", "range_no"), DETAIL_ORDER, page, size).drop("projectId")


def kept_like(details: DataFrame, grams: DataFrame, keyword: str | None) -> DataFrame:
    """The kept detail rows like a keyword with wildcards (filters.keyword_like)."""
    some = kept_with(details, grams, stored.literal_runs((keyword or "").strip()))
    return filters.keyword_like(some, DETAIL_KEYWORD_COLUMNS, keyword).drop("row_no", "range_no")


def kept_with(details: DataFrame, grams: DataFrame, runs: Sequence[str]) -> DataFrame:
    return details.filter(F.col("range_no").isin(stored.ranges_with(grams, runs))) if runs else details


def filter_view(rows: DataFrame, platform: str | None = None, languages: Sequence[str] = (),
                chart: str = "bar") -> DataFrame:
    """Ranking rows by platform and languages, cut as the chart needs: the first 15 (bar) or 20 (line) by
    stars, or the first 7 and the rest (pie)."""
    chosen = filters.multi_select(rows, platform, languages)
    if chart == "pie":
        return topk.top_and_rest(chosen, "fullName", "starsCount", ["starsCount"], ties=["ranking"])
    count = {"bar": V.CHART_ROWS, "line": V.LINE_ROWS}[chart]
    return topk.top_rows(chosen, "starsCount", count, ["ranking"])


def distinct_languages(rows: DataFrame, column: str = "language") -> DataFrame:
    """The language choices of a result: distinct, not blank, sorted."""
    return rows.filter(F.col(column).isNotNull() & (F.col(column) != "")).select(column).distinct().orderBy(column)


def language_fold(languages: DataFrame) -> DataFrame:
    """First 7 languages by repositories, the rest as one."""
    return topk.top_and_rest(languages, "language", "repoCount", ["repoCount", "totalStars"])


def language_table(languages: DataFrame) -> DataFrame:
    """First 15 languages, numbered, with their share."""
    top = topk.top_rows(languages, "repoCount", V.CHART_ROWS, ["language"])
    return topk.numbered(top, "repoCount", ["language"], "row_no").select("row_no", "language", "repoCount", "pctOfTotal")


def top_orgs(orgs: DataFrame) -> DataFrame:
    return topk.top_rows(orgs, "totalStars", V.CHART_ROWS, ["orgName"])


def peak_month(trend: DataFrame) -> DataFrame:
    """The month with the most cumulative stars, the earlier of equals."""
    return trend.orderBy(F.col("cumulativeStars").desc(), "month").limit(1)


def compare_pool(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Candidates of the comparison: the 20 most starred."""
    return topk.top_rows(repo_details(fact, dim), "starsCount", V.COMPARE_POOL, ["projectId"])


def selected_repos(fact: DataFrame, dim: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """The chosen repositories out of the pool; the first 3 when none are named, an error beyond 6."""
    pool = compare_pool(fact, dim)
    if names is None:
        return topk.top_rows(pool, "starsCount", V.COMPARE_DEFAULT, ["projectId"])
    if len(set(names)) > V.COMPARE_MAX:
        raise ValueError(f"at most {V.COMPARE_MAX} repositories can be compared")
    return pool.filter(F.col("fullName").isin(list(names)))


def q_compare(fact: DataFrame, dim: DataFrame, names: Sequence[str] | None = None,
              measure: str = "starsCount") -> DataFrame:
    """Side by side: each measure with its axis bound and scaled value, and the share of one measure."""
    if measure not in MEASURES:
        raise ValueError(f"unknown measure {measure}")
    chosen = selected_repos(fact, dim, names).select("fullName", *MEASURES)
    scaled = shares.relative_to_max(chosen, MEASURES).withColumn("_value", F.coalesce(measure, F.lit(0)))
    return wire_form(shares.share_of_total(scaled, "_value", "share", shares.selection_total("_value")).drop("_value"))


def latest_log_rows(log: DataFrame) -> DataFrame:
    return log.orderBy(F.col("log_id").desc()).limit(V.LOG_ROWS)


def q_audit_log(log: DataFrame, action: str | None = None, keyword: str | None = None, page: int = 1,
                size: int = 10) -> DataFrame:
    """One page of the newest 200 audit rows that fit."""
    found = filters.action_and_keyword(latest_log_rows(log), action, keyword)
    return paging.page_rows(found, [("log_id", False)], page, size)


def audit_counts(log: DataFrame, user: str | None = None, login: str = V.LOGIN_ACTION,
                 export: str = V.EXPORT_ACTION) -> DataFrame:
    """Logins, exports and all actions of one user, or of every user, in one pass."""
    counts = [
        count_if(F.col("action") == login).alias("loginCount"),
        count_if(F.col("action") == export).alias("exportCount"),
        F.count(F.lit(1)).alias("logCount"),
    ]
    if user is not None:
        return log.filter(F.col("username") == user).agg(*counts)
    return log.groupBy("username").agg(*counts)
