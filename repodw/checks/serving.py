"""Serving queries, filters, paging, profile and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from repodw import fixed_values as V
from repodw.checks.bindings import Audit, Documents, Events, Lines
from repodw.checks.registry import query, sql_day, sql_ratio
from repodw.checks.rollups import (
    E, ER, LANGUAGE, LR, ORGS, OVERVIEW, RANKING, TREND_HISTORY, TREND_SNAPSHOTS, languages_of, merged_of, orgs_of,
    ranking_of, trend_history_of,
)
from repodw.operators import filters, latest, paging, stored
from repodw.plans import ads, dwd, dws, profile, serve
from repodw.session import scratch_dir, written
from repodw.sources import export
from repodw.sources.store import Warehouse

A, O = Audit.SQL, Documents.SQL

DETAIL = """,
detail AS (
  SELECT project_id, d.full_name AS "fullName", f.org_name AS "orgName", d.language, d.source_platform AS platform,
         f.stars_count AS "starsCount", f.forks_count AS "forksCount", f.watchers_count AS "watchersCount",
         f.open_issues_count AS "openIssuesCount", CAST(f.snapshot_date AS VARCHAR) AS "snapshotDate"
  FROM fx_last JOIN fx_fact f ON f.snapshot_date = fx_last.day JOIN fx_dim d USING (project_id))"""
_DETAIL_COLUMNS = ('"fullName", language, platform, "orgName", "starsCount", "forksCount", "watchersCount", '
                   '"openIssuesCount", "snapshotDate"')
ED = E + DETAIL


# --- filters ---------------------------------------------------------------------------------------------------

@query("equals_filter", Events, E + f"""
SELECT project_id, org_name, stars_count, {sql_day('snapshot_date')} AS snapshot_date FROM fx_fact
WHERE org_name = 'NATION_7'""")
def _(e):
    return filters.equals_filter(e.fact, "org_name", "  NATION_7 ").select(
        "project_id", "org_name", "stars_count", "snapshot_date"
    )


@query("keyword_any_like", Events, ED + f"""
SELECT {_DETAIL_COLUMNS} FROM detail
WHERE "fullName" ILIKE '%n_1%' OR "orgName" ILIKE '%n_1%' OR language ILIKE '%n_1%'""")
def _(e):
    return filters.keyword_like(serve.repo_details(e.fact, e.projects), serve.DETAIL_KEYWORD_COLUMNS, "n_1").drop("projectId")


@query("keyword_contains", Events, ED + f"""
SELECT {_DETAIL_COLUMNS} FROM detail
WHERE contains(lower(coalesce("fullName", '')), 'uild') OR contains(lower(coalesce("orgName", '')), 'uild')
   OR contains(lower(coalesce(language, '')), 'uild')""")
def _(e):
    rows = serve.repo_details(e.fact, e.projects)
    return filters.keyword_contains(rows, serve.DETAIL_KEYWORD_COLUMNS, " UILD ").drop("projectId")


@query("multi_select", Events, ED + f"""
SELECT {_DETAIL_COLUMNS} FROM detail WHERE platform = 'gitee' AND language IN ('BUILDING', 'MACHINERY')""")
def _(e):
    rows = serve.repo_details(e.fact, e.projects)
    return filters.multi_select(rows, "gitee", ["BUILDING", "MACHINERY"]).drop("projectId")


@query("type_and_keyword", Audit, A + """
SELECT log_id, username, action, detail FROM fx_log
WHERE action = 'purchase' AND (contains(lower(username), '9') OR contains(lower(detail), '9'))""")
def _(a):
    return filters.action_and_keyword(a.log, "purchase", "9").select("log_id", "username", "action", "detail")


# --- serving ---------------------------------------------------------------------------------------------------

@query("q_overview", Events, f"""
SELECT stat_date AS "statDate", total_repos AS "totalRepos", total_stars AS "totalStars", total_forks AS "totalForks",
       avg_stars AS "avgStars", total_orgs AS "totalOrgs", gitee_repos AS "giteeRepos", github_repos AS "githubRepos"
FROM ({OVERVIEW})""")
def _(e):
    return serve.q_overview(ads.overview(e.projects, e.fact, e.last))


RANKING_OUT = """,
q_ranking AS (
  SELECT CAST(rank_num AS INT) AS ranking, project_name AS "projectName", full_name AS "fullName",
         org_name AS "orgName", language, stars_count AS "starsCount", forks_count AS "forksCount",
         star_growth AS "starGrowth", source_platform AS platform FROM ranking)"""


@query("q_ranking", Events, ER + RANKING + RANKING_OUT + "SELECT * FROM q_ranking")
def _(e):
    return serve.q_ranking(written(ranking_of(e), "mart"))


@query("q_language", Events, ER + LANGUAGE + """
SELECT language, repo_count AS "repoCount", total_stars AS "totalStars", pct_of_total AS "pctOfTotal" FROM dist""")
def _(e):
    return serve.q_language(written(languages_of(e), "mart"))


_TREND_OUT = """
SELECT stat_month AS month, new_repos AS "newRepos", active_repos AS "activeRepos", new_stars AS "newStars",
       cumulative_stars AS "cumulativeStars" FROM trend"""
_TREND = LR + TREND_SNAPSHOTS + TREND_HISTORY + """,
trend AS (SELECT * FROM trend_h
          UNION ALL SELECT * FROM trend_s WHERE stat_month NOT IN (SELECT stat_month FROM trend_h))"""


@query("q_trend", Lines, _TREND + _TREND_OUT)
def _(l):
    return serve.q_trend(merged_of(l))


@query("peak_point", Lines, LR + TREND_HISTORY + _TREND_OUT.replace("FROM trend", "FROM trend_h") + """
ORDER BY cumulative_stars DESC, stat_month LIMIT 1""")
def _(l):
    return serve.peak_month(serve.q_trend(trend_history_of(l)))


_ORGS_OUT = """
SELECT org_name AS "orgName", source_platform AS platform, repo_count AS "repoCount", total_stars AS "totalStars",
       avg_stars AS "avgStars", active_rate AS "activeRate" FROM orgs"""


@query("q_org_compare", Events, ER + ORGS + _ORGS_OUT)
def _(e):
    return serve.q_org_compare(written(orgs_of(e), "mart"))


@query("topn_orgs", Events, ER + ORGS + _ORGS_OUT + " ORDER BY total_stars DESC, org_name LIMIT 15")
def _(e):
    return serve.top_orgs(serve.q_org_compare(written(orgs_of(e), "mart")))


@query("topn_languages", Events, ER + LANGUAGE + """
SELECT CAST(row_number() OVER (ORDER BY repo_count DESC, language) AS INT) AS row_no, language, repo_count AS "repoCount",
       pct_of_total AS "pctOfTotal" FROM dist ORDER BY 1 LIMIT 15""")
def _(e):
    return serve.language_table(serve.q_language(written(languages_of(e), "mart")))


@query("language_fold", Events, ER + LANGUAGE + """
SELECT CASE WHEN rn <= 7 THEN language ELSE '其他' END AS language, CAST(sum(repo_count) AS BIGINT) AS "repoCount",
       CAST(sum(total_stars) AS BIGINT) AS "totalStars"
FROM (SELECT *, row_number() OVER (ORDER BY repo_count DESC, language) AS rn FROM dist) GROUP BY 1""")
def _(e):
    return serve.language_fold(serve.q_language(written(languages_of(e), "mart")))


@query("q_org_repos", Events, ED + """
SELECT "fullName", language, platform, "starsCount", "forksCount", "watchersCount", "snapshotDate" FROM detail
WHERE "orgName" = 'NATION_11'""")
def _(e):
    return serve.q_org_repos(e.fact, e.projects, " NATION_11")


@query("q_repos", Events, ED + f"SELECT {_DETAIL_COLUMNS} FROM detail")
def _(e):
    return serve.q_repos(e.fact, e.projects)


@query("sort_views", Events, ED + f"""
SELECT {_DETAIL_COLUMNS} FROM detail ORDER BY "starsCount" DESC, project_id""")
def _(e):
    return serve.q_repos(e.fact, e.projects)


_PAGE = """,
found AS (SELECT *, row_number() OVER (ORDER BY "starsCount" DESC, project_id) AS rn, count(*) OVER () AS n FROM detail
          WHERE {where}),
paged AS (SELECT *, CAST(ceil(n / {size}.0) AS BIGINT) AS pages FROM found)
SELECT {columns}, CAST(rn AS INT) AS row_no, n AS total_rows, pages AS total_pages FROM paged
WHERE rn > (least({page}, pages) - 1) * {size} AND rn <= least({page}, pages) * {size}"""


@query("page_rows", Events, ED + _PAGE.format(where="TRUE", size=20, page=3, columns=_DETAIL_COLUMNS))
def _(e):
    rows = serve.repo_details(e.fact, e.projects)
    return paging.page_rows(rows, serve.DETAIL_ORDER, page=3, size=20).drop("projectId")


@query("page_rows_past_end", Events, ED + _PAGE.format(where="TRUE", size=50, page=99999, columns=_DETAIL_COLUMNS))
def _(e):
    rows = serve.repo_details(e.fact, e.projects)
    return paging.page_rows(rows, serve.DETAIL_ORDER, page=99999, size=50).drop("projectId")


def _kept(e):
    rows = written(serve.kept_details(e.fact, e.projects), "kept")
    ranges = stored.ranges_of(rows)
    grams = written(stored.grams_of(rows, serve.DETAIL_KEYWORD_COLUMNS), "grams")
    return written(stored.numbered(rows, ranges), "numbered"), ranges, grams


@query("page_rows_stored", Events, ED + _PAGE.format(where="TRUE", size=20, page=3, columns=_DETAIL_COLUMNS))
def _(e):
    """page_rows out of detail rows kept in their order."""
    return serve.kept_search_page(*_kept(e), None, page=3, size=20)


@query("search_page_stored", Events, ED + _PAGE.format(
    where="""contains(lower("fullName"), 'nation_1') OR contains(lower("orgName"), 'nation_1')
             OR contains(lower(language), 'nation_1')""", size=10, page=2, columns=_DETAIL_COLUMNS))
def _(e):
    """q_search_page out of the ranges of kept detail rows that hold the keyword's grams."""
    return serve.kept_search_page(*_kept(e), "Nation_1", page=2, size=10)


@query("keyword_like_stored", Events, ED + f"""
SELECT {_DETAIL_COLUMNS} FROM detail
WHERE "fullName" ILIKE '%n_1%omer%' OR "orgName" ILIKE '%n_1%omer%' OR language ILIKE '%n_1%omer%'""")
def _(e):
    details, _ranges, grams = _kept(e)
    return serve.kept_like(details, grams, "n_1%omer").drop("projectId")


@query("page_rows_stored_deep", Audit, A + """,
counted AS (SELECT *, row_number() OVER (ORDER BY log_id) AS rn, count(*) OVER () AS n FROM fx_log),
paged AS (SELECT *, CAST(ceil(n / 50.0) AS BIGINT) AS pages FROM counted)
SELECT log_id, username, action, CAST(rn AS INT) AS row_no, n AS total_rows, pages AS total_pages FROM paged
WHERE rn > (least(80, pages) - 1) * 50 AND rn <= least(80, pages) * 50""")
def _(a):
    """Page 80 of the whole log, kept in its order."""
    rows = written(stored.in_order(a.log.select("log_id", "username", "action"), [("log_id", True)]), "log")
    ranges = stored.ranges_of(rows)
    return stored.page_of(written(stored.numbered(rows, ranges), "numbered"), ranges, page=80, size=50)


@query("page_rows_deep", Audit, A + """,
counted AS (SELECT *, row_number() OVER (ORDER BY log_id) AS rn, count(*) OVER () AS n FROM fx_log),
paged AS (SELECT *, CAST(ceil(n / 50.0) AS BIGINT) AS pages FROM counted)
SELECT log_id, username, action, CAST(rn AS INT) AS row_no, n AS total_rows, pages AS total_pages FROM paged
WHERE rn > (least(80, pages) - 1) * 50 AND rn <= least(80, pages) * 50""")
def _(a):
    """Page 80 of the whole log by the narrowing way that deep pages take."""
    rows = a.log.select("log_id", "username", "action")
    return paging.page_rows(rows, [("log_id", True)], page=80, size=50)


@query("q_search_page", Events, ED + _PAGE.format(
    where="""contains(lower("fullName"), 'nation_1') OR contains(lower("orgName"), 'nation_1')
             OR contains(lower(language), 'nation_1')""", size=10, page=2, columns=_DETAIL_COLUMNS))
def _(e):
    return serve.q_search_page(e.fact, e.projects, "Nation_1", page=2, size=10)


_VIEW = ER + RANKING + RANKING_OUT


@query("q_filter_view", Events, _VIEW + """,
chosen AS (SELECT *, row_number() OVER (ORDER BY "starsCount" DESC, ranking) AS rn FROM q_ranking
           WHERE platform = 'github')
SELECT CASE WHEN rn <= 7 THEN "fullName" ELSE '其他' END AS "fullName", CAST(sum("starsCount") AS BIGINT) AS "starsCount"
FROM chosen GROUP BY 1""")
def _(e):
    return serve.filter_view(serve.q_ranking(written(ranking_of(e), "mart")), platform="github", chart="pie")


@query("topn_chart", Events, _VIEW + """
SELECT * FROM q_ranking WHERE language IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD', 'AUTOMOBILE')
ORDER BY "starsCount" DESC, ranking LIMIT 15""")
def _(e):
    languages = ["BUILDING", "MACHINERY", "HOUSEHOLD", "AUTOMOBILE"]
    return serve.filter_view(serve.q_ranking(written(ranking_of(e), "mart")), languages=languages, chart="bar")


@query("distinct_languages", Events, _VIEW + "SELECT DISTINCT language FROM q_ranking WHERE language <> ''")
def _(e):
    return serve.distinct_languages(serve.q_ranking(written(ranking_of(e), "mart")))


_POOL = ED + """,
pool AS (SELECT *, row_number() OVER (ORDER BY "starsCount" DESC, project_id) AS rn FROM detail
         ORDER BY "starsCount" DESC, project_id LIMIT 20)"""


@query("compare_pool", Events, _POOL + f"SELECT {_DETAIL_COLUMNS} FROM pool")
def _(e):
    return serve.compare_pool(e.fact, e.projects).drop("projectId")


def _scaled_sql(measure: str) -> str:
    top = f'greatest(1, max("{measure}") OVER ())'
    return (f'"{measure}", CAST({top} AS BIGINT) AS "{measure}_max", '
            f'CAST("{measure}" AS DOUBLE) / {top} AS "{measure}_scaled"')


_SCALES = ", ".join(_scaled_sql(m) for m in serve.MEASURES)


@query("selected_max_scale", Events, _POOL + f'SELECT "fullName", {_SCALES} FROM pool WHERE rn <= 3')
def _(e):
    return serve.q_compare(e.fact, e.projects).drop("share")


@query("selected_share", Events, _POOL + f"""
SELECT "fullName", "forksCount", {sql_ratio('100 * "forksCount"', 'sum("forksCount") OVER ()')} AS share
FROM pool WHERE rn <= 3""")
def _(e):
    return serve.q_compare(e.fact, e.projects, measure="forksCount").select("fullName", "forksCount", "share")


@query("q_compare", Events, _POOL + f"""
SELECT "fullName", {_SCALES}, {sql_ratio('100 * "watchersCount"', 'sum("watchersCount") OVER ()')} AS share
FROM (FROM pool WHERE platform = 'gitee' ORDER BY rn LIMIT 6)""")
def _(e):
    """The six most starred of the pool on one platform are chosen."""
    pool = serve.compare_pool(e.fact, e.projects).filter("platform = 'gitee'")
    best = pool.orderBy(F.col("starsCount").desc(), "projectId").limit(V.COMPARE_MAX)
    names = [row["fullName"] for row in best.collect()]
    return serve.q_compare(e.fact, e.projects, names, "watchersCount")


_LOG_OUT = "log_id, username, action, detail, strftime(create_time, '%Y-%m-%d %H:%M:%S') AS create_time"


@query("latest_log_rows", Audit, A + f"SELECT {_LOG_OUT} FROM fx_log ORDER BY log_id DESC LIMIT 200")
def _(a):
    return serve.latest_log_rows(a.log)


@query("q_audit_log", Audit, A + f""",
newest AS (SELECT * FROM fx_log ORDER BY log_id DESC LIMIT 200),
found AS (SELECT *, row_number() OVER (ORDER BY log_id DESC) AS rn, count(*) OVER () AS n FROM newest
          WHERE action = 'click' AND (contains(lower(username), 'u1') OR contains(lower(detail), 'u1')))
SELECT {_LOG_OUT}, CAST(rn AS INT) AS row_no, n AS total_rows, CAST(ceil(n / 10.0) AS BIGINT) AS total_pages
FROM found WHERE rn <= 10""")
def _(a):
    return serve.q_audit_log(a.log, "click", "U1", page=1, size=10)


@query("audit_counts", Audit, A + """
SELECT username, count(*) FILTER (action = 'signup') AS "loginCount", count(*) FILTER (action = 'purchase') AS "exportCount",
       count(*) AS "logCount" FROM fx_log GROUP BY 1""")
def _(a):
    return serve.audit_counts(a.log, login="signup", export="purchase")


@query("audit_counts_user", Audit, A + """
SELECT count(*) FILTER (action = 'signup') AS "loginCount", count(*) FILTER (action = 'purchase') AS "exportCount",
       count(*) AS "logCount" FROM fx_log WHERE username = 'u7'""")
def _(a):
    return serve.audit_counts(a.log, "u7", login="signup", export="purchase")


@query("export_csv", Events, ED + f"""
SELECT "fullName" AS "{V.EXPORT_HEADER[0]}", "orgName" AS "{V.EXPORT_HEADER[1]}", language AS "{V.EXPORT_HEADER[2]}",
       platform AS "{V.EXPORT_HEADER[3]}", "starsCount" AS "Star", "forksCount" AS "Fork", "watchersCount" AS "Watch",
       "openIssuesCount" AS "Issues", "snapshotDate" AS "{V.EXPORT_HEADER[8]}"
FROM detail WHERE "fullName" ILIKE '%build%' OR "orgName" ILIKE '%build%' OR language ILIKE '%build%'""")
def _(e):
    """Written as CSV and read back."""
    folder = scratch_dir(e.spark, "export")
    export.write_csv(export.export_rows(e.fact, e.projects, "build"), folder)
    types = ["string"] * 4 + ["bigint"] * 4 + ["string"]
    schema = ", ".join(f"`{name}` {kind}" for name, kind in zip(V.EXPORT_HEADER, types))
    return e.spark.read.option("header", "true").option("enforceSchema", "true").schema(schema).csv(folder)


# --- profile ---------------------------------------------------------------------------------------------------

_CLEAN = f""",
recs AS (SELECT f.project_id AS repo_id, d.full_name, f.org_name AS org, f.source_platform, f.stars_count, f.forks_count,
                CASE WHEN d.language = 'BUILDING' THEN '{V.NO_LANGUAGE}' ELSE d.language END AS language
         FROM fx_fact f JOIN fx_dim d ON f.project_id = d.project_id)"""
EC = E + _CLEAN


def _records(e):
    names = e.projects.select(
        "project_id", "full_name",
        F.when(F.col("language") == "BUILDING", V.NO_LANGUAGE).otherwise(F.col("language")).alias("language"),
    )
    return e.fact.join(names, "project_id").withColumnsRenamed({"project_id": "repo_id", "org_name": "org"})


@query("prof_totals", Events, EC + f"""
SELECT count(*) AS total_rows, CAST(sum(stars_count) AS BIGINT) AS total_stars,
       CAST(sum(forks_count) AS BIGINT) AS total_forks, {sql_ratio('sum(stars_count)', 'count(stars_count)')} AS avg_stars,
       CAST(median(stars_count) AS DOUBLE) AS median_stars FROM recs""")
def _(e):
    return profile.prof_totals(_records(e))


@query("prof_platform", Events, EC + f"""
SELECT source_platform, count(repo_id) AS repos, CAST(sum(stars_count) AS BIGINT) AS total_stars,
       {sql_ratio('sum(stars_count)', 'count(stars_count)')} AS avg_stars,
       count(*) FILTER (language <> '{V.NO_LANGUAGE}') AS with_language,
       {sql_ratio(f"100 * count(*) FILTER (language <> '{V.NO_LANGUAGE}')", 'count(repo_id)')} AS language_rate
FROM recs GROUP BY 1""")
def _(e):
    return profile.prof_platform(_records(e))


@query("prof_org", Events, EC + """
SELECT org, source_platform, count(repo_id) AS repos, CAST(sum(stars_count) AS BIGINT) AS total_stars FROM recs
GROUP BY 1, 2""")
def _(e):
    return profile.prof_org(_records(e))


@query("prof_star_bins", Events, EC + f""",
bins(bin_no, star_range, low, high) AS (VALUES (0, '0', 0, 1), (1, '1-9', 1, 10), (2, '10-49', 10, 50),
  (3, '50-99', 50, 100), (4, '100-499', 100, 500), (5, '500-999', 500, 1000), (6, '1000+', 1000, 9999999999))
SELECT b.bin_no, b.star_range, count(r.repo_id) AS repos,
       {sql_ratio('100 * count(r.repo_id)', '(SELECT count(*) FROM recs)')} AS pct
FROM bins b LEFT JOIN recs r ON r.stars_count >= b.low AND r.stars_count < b.high GROUP BY 1, 2""")
def _(e):
    return profile.prof_star_bins(_records(e))


@query("prof_top15", Events, EC.replace("f.stars_count, f.forks_count,", "f.stars_count, f.forks_count, f.snapshot_date,") + """
SELECT full_name, stars_count, forks_count, language, source_platform FROM recs
ORDER BY stars_count DESC, repo_id, snapshot_date LIMIT 15""")
def _(e):
    return profile.prof_top15(_records(e), ("repo_id", "snapshot_date"))


@query("prof_lang_top10", Events, EC + f"""
SELECT language, count(*) AS repos, {sql_ratio('100 * count(*)', '(SELECT count(*) FROM recs)')} AS pct FROM recs
GROUP BY 1 ORDER BY repos DESC, language LIMIT 10""")
def _(e):
    return profile.prof_lang_top10(_records(e))


@query("prof_year", Lines, """
SELECT CAST(year(o_orderdate - INTERVAL 8 HOUR) AS INT) AS year, count(*) AS repos FROM orders GROUP BY 1""")
def _(l):
    return profile.prof_year(l.ods)


@query("prof_license", Documents, """
SELECT source AS license, count(*) AS repos FROM documents WHERE source <> 'src3' GROUP BY 1
ORDER BY repos DESC, license LIMIT 10""")
def _(o):
    blank = F.when(F.col("org") == "src3", "").otherwise(F.col("org"))
    return profile.prof_license(o.raw.withColumn("license_type", blank))


@query("ingest_split", Events, E + """
SELECT count(*) FILTER (source_platform = 'gitee') AS gitee_rows,
       count(*) FILTER (source_platform = 'github') AS github_rows FROM fx_fact""")
def _(e):
    return profile.ingest_split(e.fact)


# --- table writes ----------------------------------------------------------------------------------------------

@query("append_fact", Events, E + f"""
SELECT project_id, org_name, CAST(stars_count AS INT) AS stars_count, {sql_day('snapshot_date')} AS snapshot_date
FROM fx_fact""")
def _(e):
    """All load days, then the newest one again: the day is replaced, not doubled."""
    warehouse = Warehouse(e.spark, scratch_dir(e.spark, "facts"))
    warehouse.replace_days("fact_repo_stats", dwd.fact_rows(e.ods))
    newest = latest.latest_partition(e.ods)
    warehouse.replace_days("fact_repo_stats", dwd.fact_rows(newest), [e.last.isoformat()])
    return warehouse.read("fact_repo_stats").select("project_id", "org_name", "stars_count", "snapshot_date")


@query("upsert_partition", Events, ER + f"""
SELECT org_name, repo_count, {sql_day('snapshot_date')} AS snapshot_date FROM od
WHERE snapshot_date < DATE '2024-01-30'
UNION ALL
SELECT org_name, repo_count + 1, {sql_day('snapshot_date')} FROM od WHERE snapshot_date = DATE '2024-01-30'
  AND repo_count > 1""")
def _(e):
    """All days written, then the newest one again with other numbers and fewer rows."""
    warehouse = Warehouse(e.spark, scratch_dir(e.spark, "mart"))
    orgs = dws.org_daily(e.fact)
    warehouse.replace_days("dws_org_daily", orgs)
    newest = orgs.filter("snapshot_date = DATE '2024-01-30' AND repo_count > 1")
    warehouse.replace_days("dws_org_daily", newest.withColumn("repo_count", F.col("repo_count") + 1), ["2024-01-30"])
    return warehouse.read("dws_org_daily").select("org_name", "repo_count", "snapshot_date")
