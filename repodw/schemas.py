"""Explicit schemas, so that no read infers types and partition columns keep theirs."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "DECIMAL(10,2)": T.DecimalType(10, 2),
    "DECIMAL(5,2)": T.DecimalType(5, 2),
}


def _schema(columns: str) -> T.StructType:
    """From column definitions as in CREATE TABLE; Spark's own parser would need a session at import."""
    pairs = [column.split(" ", 1) for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in pairs])


# A raw record. `topics` is read as text: a JSON list arrives as its JSON text (see topics_to_text).
RAW = _schema(
    "repo_id BIGINT, org STRING, name STRING, full_name STRING, description STRING, language STRING, "
        "stars_count INT, forks_count INT, watchers_count INT, open_issues_count INT, default_branch STRING, "
        "html_url STRING, topics STRING, license_type STRING, license STRING, homepage STRING, archived BOOLEAN, "
        "created_at STRING, updated_at STRING, pushed_at STRING, source_platform STRING"
    )

# What a raw file may lack altogether, with the value the whole column then gets.
RAW_DEFAULTS = {"topics": "", "license": "", "homepage": "", "archived": False, "source_platform": "unknown"}

# A repository as the hosting platforms' APIs return it.
PAYLOAD = T.StructType(
    _schema(
        "id BIGINT, name STRING, full_name STRING, description STRING, language STRING, stargazers_count INT, "
        "forks_count INT, watchers_count INT, open_issues_count INT, default_branch STRING, html_url STRING, "
        "homepage STRING, archived BOOLEAN, created_at STRING, updated_at STRING, pushed_at STRING"
    ).fields
    + [
        T.StructField("topics", T.ArrayType(T.StringType())),
        T.StructField("license", T.StructType([T.StructField("spdx_id", T.StringType())])),
        T.StructField("owner", T.StructType([T.StructField("login", T.StringType())])),
        T.StructField("namespace", T.StructType([T.StructField("path", T.StringType())])),
    ]
)

TABLES = {
    # The raw files that were loaded, by their path below the landing folder, with the day each was given for good.
    "landed_files": _schema("file STRING, dated BOOLEAN, etl_time TIMESTAMP, dt STRING"),
    "ods_repos_raw": _schema(
        "repo_id BIGINT, org STRING, name STRING, full_name STRING, description STRING, stars_count INT, "
        "forks_count INT, watchers_count INT, open_issues_count INT, language STRING, default_branch STRING, "
        "html_url STRING, topics STRING, license_type STRING, homepage STRING, archived INT, created_at STRING, "
        "updated_at STRING, pushed_at STRING, source_platform STRING, etl_time TIMESTAMP, dt STRING"
    ),
    "dim_project": _schema(
        "project_id BIGINT, project_name STRING, full_name STRING, description STRING, language STRING, "
        "topics STRING, license_type STRING, html_url STRING, source_platform STRING, created_at TIMESTAMP_NTZ, "
        "etl_time TIMESTAMP"
    ),
    "dim_org": _schema("org_name STRING, source_platform STRING, etl_time TIMESTAMP"),
    "dim_date": _schema(
        "date_id DATE, year INT, quarter INT, month INT, day INT, week_of_year INT, day_of_week INT, "
        "is_weekend INT"
    ),
    "fact_repo_stats": _schema(
        "project_id BIGINT, org_name STRING, source_platform STRING, stars_count INT, forks_count INT, "
        "watchers_count INT, open_issues_count INT, dt STRING, snapshot_date DATE"
    ),
    "dws_project_daily": _schema(
        "project_id BIGINT, total_cum_stars INT, total_cum_forks INT, curr_day_new_stars INT, "
        "curr_day_new_forks INT, curr_day_new_issues INT, snapshot_date DATE"
    ),
    "dws_language_daily": _schema(
        "language STRING, repo_count BIGINT, total_stars BIGINT, total_forks BIGINT, avg_stars DECIMAL(10,2), "
        "snapshot_date DATE"
    ),
    "dws_org_daily": _schema(
        "org_name STRING, repo_count BIGINT, total_stars BIGINT, total_forks BIGINT, curr_day_new_repos BIGINT, "
        "snapshot_date DATE"
    ),
    "dws_platform_daily": _schema(
        "source_platform STRING, repo_count BIGINT, total_stars BIGINT, active_projects BIGINT, "
        "snapshot_date DATE"
    ),
    # Counts per (language, platform, day), from which both rollups above are added up.
    "dws_attribute_daily": _schema(
        "language STRING, source_platform STRING, snapshot_date DATE, projects BIGINT, stars BIGINT, "
        "starred BIGINT, forks BIGINT, active BIGINT"
    ),
    # Month sums, and what they are updated from: a load adds the difference its days make to a project's month and
    # replaces its days' sums, so that it reads neither the other days of the month nor history.
    "dws_project_month": _schema("project_id BIGINT, days BIGINT, gained BIGINT, best INT, stat_month STRING"),
    "dws_day_sums": _schema("snapshot_date DATE, org_new_repos BIGINT, platform_active BIGINT, stars BIGINT, stat_month STRING"),
    "dws_monthly": _schema(
        "org_new_repos BIGINT, platform_active BIGINT, new_stars BIGINT, month_end_stars BIGINT, "
        "active_projects BIGINT, best_stars BIGINT, stat_month STRING"
    ),
    "dws_created_monthly": _schema("stat_month STRING, new_repos BIGINT, dt STRING"),
    "ads_overview": _schema(
        "total_repos BIGINT, total_stars BIGINT, total_forks BIGINT, total_orgs BIGINT, gitee_repos BIGINT, "
        "github_repos BIGINT, avg_stars DECIMAL(10,2), stat_date DATE"
    ),
    "ads_project_ranking": _schema(
        "rank_num INT, project_name STRING, full_name STRING, org_name STRING, language STRING, stars_count INT, "
        "forks_count INT, star_growth INT, source_platform STRING, stat_date DATE"
    ),
    "ads_language_dist": _schema("language STRING, repo_count BIGINT, total_stars BIGINT, pct_of_total DECIMAL(5,2), stat_date DATE"),
    "ads_monthly_trend": _schema("new_repos BIGINT, active_repos BIGINT, new_stars BIGINT, cumulative_stars BIGINT, stat_month STRING"),
    "ads_org_compare": _schema(
        "org_name STRING, source_platform STRING, repo_count BIGINT, total_stars BIGINT, "
        "avg_stars DECIMAL(10,2), active_rate DECIMAL(5,2), stat_date DATE"
    ),
    # The newest day's detail rows in their order, how many are in each range of it, and the ranges' three-letter grams.
    "ads_repo_details": _schema(
        "projectId BIGINT, fullName STRING, language STRING, platform STRING, orgName STRING, starsCount INT, forksCount INT, "
        "watchersCount INT, openIssuesCount INT, snapshotDate STRING, row_no BIGINT, range_no INT, stat_date DATE"
    ),
    "ads_repo_ranges": _schema("range_no INT, before BIGINT, rows BIGINT, stat_date DATE"),
    "ads_repo_grams": _schema("gram STRING, range_no INT, stat_date DATE"),
    "sys_log": _schema("log_id BIGINT, username STRING, action STRING, detail STRING, ip STRING, create_time TIMESTAMP"),
}

PARTITIONED_BY = {
    "landed_files": "dt",
    "ods_repos_raw": "dt",
    "fact_repo_stats": "snapshot_date",
    "dws_project_daily": "snapshot_date",
    "dws_language_daily": "snapshot_date",
    "dws_org_daily": "snapshot_date",
    "dws_platform_daily": "snapshot_date",
    "dws_attribute_daily": "snapshot_date",
    "dws_project_month": "stat_month",
    "dws_day_sums": "stat_month",
    "dws_monthly": "stat_month",
    "dws_created_monthly": "dt",
    "ads_overview": "stat_date",
    "ads_project_ranking": "stat_date",
    "ads_language_dist": "stat_date",
    "ads_monthly_trend": "stat_month",
    "ads_org_compare": "stat_date",
    "ads_repo_details": "stat_date",
    "ads_repo_ranges": "stat_date",
    "ads_repo_grams": "stat_date",
}

# Tables laid out by hash bucket of the project as well: facts within a day, the dimension as a whole.
BUCKETED_BY = {"fact_repo_stats": "project_id", "dim_project": "project_id"}
BUCKETS = 8

# Tables with a folder for each value of a column within a day.
RANGED_BY = {"ads_repo_details": "range_no"}

# Columns that spread one partition's rows evenly over tasks when it is written.
SPREAD_BY = {
    "ods_repos_raw": ["repo_id"], "fact_repo_stats": ["project_id"], "dws_project_daily": ["project_id"],
    "dws_org_daily": ["org_name"], "dws_project_month": ["project_id"], "ads_repo_details": ["row_no"], "ads_repo_grams": ["gram"],
}

KEYS = {
    "landed_files": ["file"],
    "dws_project_month": ["project_id", "stat_month"],
    "dws_day_sums": ["snapshot_date"],
    "dim_project": ["project_id"],
    "dim_org": ["org_name", "source_platform"],
    "dim_date": ["date_id"],
    "dws_project_daily": ["project_id", "snapshot_date"],
    "dws_language_daily": ["language", "snapshot_date"],
    "dws_org_daily": ["org_name", "snapshot_date"],
    "dws_platform_daily": ["source_platform", "snapshot_date"],
    "dws_attribute_daily": ["language", "source_platform", "snapshot_date"],
    "dws_monthly": ["stat_month"],
    "dws_created_monthly": ["stat_month", "dt"],
    "ads_overview": ["stat_date"],
    "ads_project_ranking": ["stat_date", "rank_num"],
    "ads_language_dist": ["stat_date", "language"],
    "ads_monthly_trend": ["stat_month"],
    "ads_org_compare": ["stat_date", "org_name"],
    "ads_repo_details": ["row_no"],
    "ads_repo_ranges": ["range_no"],
    "ads_repo_grams": ["gram", "range_no"],
}


def raw_without(*columns: str) -> T.StructType:
    """The raw schema for older files that lack some columns altogether, so that these get their defaults."""
    return T.StructType([field for field in RAW.fields if field.name not in columns])
