import json
from datetime import date

from pyspark.sql import functions as F

TESTDATA = "/root/testdata"


def frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def facts(spark, rows):
    """(project, day of January 2024, stars, forks, issues[, org, platform])"""
    full = [(p, f"org{p % 3}" if len(r) < 2 else r[0], "github" if len(r) < 2 else r[1], date(2024, 1, d), s, f, 0, i)
            for p, d, s, f, i, *r in rows]
    return spark.createDataFrame(
        full, "project_id long, org_name string, source_platform string, snapshot_date date, stars_count int, "
              "forks_count int, watchers_count int, open_issues_count int")


def projects(spark, rows):
    return spark.createDataFrame(rows, "project_id long, full_name string, language string, source_platform string").withColumn(
        "project_name", F.col("full_name"))


def record(repo_id, platform="github", **values):
    base = {
        "repo_id": repo_id, "org": "org1", "name": f"r{repo_id}", "full_name": f"org1/r{repo_id}", "description": "text",
        "language": "Go", "stars_count": 1, "forks_count": 2, "watchers_count": 3, "open_issues_count": 0,
        "default_branch": "main", "html_url": "https://x", "topics": "", "license_type": "MIT", "homepage": "",
        "archived": False, "created_at": "2020-01-02T03:04:05+08:00", "updated_at": "", "pushed_at": "",
        "source_platform": platform,
    }
    return {**base, **values}


def land(folder, platform, day, records, indent=2):
    path = folder / f"{platform}_repos_{day.replace('-', '')}.json"
    path.write_text(json.dumps(records, ensure_ascii=False, indent=indent), encoding="utf-8")
    return path
