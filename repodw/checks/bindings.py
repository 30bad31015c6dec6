"""The given test tables read as repository data. The only place that knows their names.

Each binding exists twice: as DataFrames, and as the SQL the equivalent queries start from.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repodw.operators.latest import newest_value
from repodw.operators.spread import parts_for, spread


class Tables:
    parts: int | None = None  # partitions for the facts; None leaves them to Spark

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


class Events(Tables):
    """Events as daily snapshots: a customer is a project, a market segment a language, a nation an
    organisation."""

    SQL = """WITH fx_dim AS (
  SELECT c.c_custkey AS project_id, c.c_name AS project_name, n.n_name || '/' || c.c_name AS full_name,
         c.c_mktsegment AS language, n.n_name AS org_name,
         CASE WHEN c.c_nationkey % 2 = 0 THEN 'gitee' ELSE 'github' END AS source_platform
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
fx_fact AS (
  SELECT e.user_id AS project_id, d.org_name, d.source_platform, CAST(e.ts AS DATE) AS snapshot_date,
         CAST(floor(max(e.value)) AS BIGINT) AS stars_count,
         count(*) AS forks_count,
         count(DISTINCT e.event_type) AS watchers_count,
         CAST(sum(CASE WHEN e.event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS open_issues_count
  FROM events e JOIN fx_dim d ON e.user_id = d.project_id
  GROUP BY 1, 2, 3, 4),
fx_last AS (SELECT max(snapshot_date) AS day FROM fx_fact),
fx_dim_org AS (SELECT DISTINCT org_name, source_platform FROM fx_fact)"""

    @cached_property
    def dim(self) -> DataFrame:
        c, n = self.table("customer"), self.table("nation")
        return c.join(n, c.c_nationkey == n.n_nationkey).select(
            F.col("c_custkey").alias("project_id"),
            F.col("c_name").alias("project_name"),
            F.concat("n_name", F.lit("/"), "c_name").alias("full_name"),
            F.col("c_mktsegment").alias("language"),
            F.col("n_name").alias("org_name"),
            F.when(F.col("c_nationkey") % 2 == 0, "gitee").otherwise("github").alias("source_platform"),
        )

    @cached_property
    def projects(self) -> DataFrame:
        """The project dimension as the warehouse has it, without the organisation."""
        return self.dim.drop("org_name")

    @cached_property
    def fact(self) -> DataFrame:
        # Reduced to one row per project and day before the join.
        days = self.table("events").groupBy(
            F.col("user_id").alias("project_id"), F.col("ts").cast("date").alias("snapshot_date")
        ).agg(
            F.floor(F.max("value")).cast("long").alias("stars_count"),
            F.count(F.lit(1)).alias("forks_count"),
            F.countDistinct("event_type").alias("watchers_count"),
            F.count(F.when(F.col("event_type") == "error", 1)).alias("open_issues_count"),
        )
        return days.join(self.dim.select("project_id", "org_name", "source_platform"), "project_id").select(
            "project_id", "org_name", "source_platform", "snapshot_date", "stars_count", "forks_count",
            "watchers_count", "open_issues_count",
        )

    @cached_property
    def last(self) -> date:
        """The newest snapshot day."""
        return newest_value(self.fact, "snapshot_date")

    @cached_property
    def dim_org(self) -> DataFrame:
        return self.fact.select("org_name", "source_platform").distinct()

    @cached_property
    def ods(self) -> DataFrame:
        """Raw-layer rows; the language carries the day, so that a later day changes it."""
        names = self.dim.select("project_id", "project_name", "full_name", "language")
        day = F.col("snapshot_date").cast("string")
        return self.fact.join(names, "project_id").select(
            F.col("project_id").alias("repo_id"), F.col("project_name").alias("name"), "full_name",
            F.lit("").alias("description"), F.concat("language", F.lit("@"), day).alias("language"),
            F.lit("").alias("topics"), F.lit("").alias("license_type"), F.lit("").alias("html_url"),
            "source_platform", F.col("org_name").alias("org"),
            F.concat(day, F.lit("T08:00:00+08:00")).alias("created_at"),
            "stars_count", "forks_count", "watchers_count", "open_issues_count", day.alias("dt"),
        )

    ODS_SQL = """,
fx_ods AS (
  SELECT f.project_id AS repo_id, d.project_name AS name, d.full_name, '' AS description,
         d.language || '@' || CAST(f.snapshot_date AS VARCHAR) AS language, '' AS topics, '' AS license_type,
         '' AS html_url, f.source_platform, f.org_name AS org,
         CAST(f.snapshot_date AS VARCHAR) || 'T08:00:00+08:00' AS created_at, f.stars_count, f.forks_count,
         f.watchers_count, f.open_issues_count, CAST(f.snapshot_date AS VARCHAR) AS dt
  FROM fx_fact f JOIN fx_dim d ON f.project_id = d.project_id)"""


class Lines(Tables):
    """Line items as a long history: a supplier is a project; orders give the creation times."""

    SQL = """WITH fx_ods AS (
  SELECT o_orderkey AS repo_id, o_custkey AS org_key, o_orderstatus AS source_platform,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+08:00' AS created_at
  FROM orders),
fx_dim AS (
  SELECT s_suppkey AS project_id, s_name AS project_name, 'L' || s_nationkey % 5 AS language,
         'N' || s_nationkey AS org_name,
         CASE WHEN s_nationkey % 2 = 0 THEN 'gitee' ELSE 'github' END AS source_platform
  FROM supplier),
fx_fact AS (
  SELECT l_suppkey AS project_id, d.org_name, d.source_platform, CAST(l_shipdate AS DATE) AS snapshot_date,
         CAST(max(l_quantity) AS BIGINT) AS stars_count,
         CAST(max(l_linenumber) AS BIGINT) AS forks_count,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS open_issues_count
  FROM lineitem JOIN fx_dim d ON l_suppkey = d.project_id GROUP BY 1, 2, 3, 4)"""

    @cached_property
    def ods(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("repo_id"), F.col("o_custkey").alias("org_key"),
            F.col("o_orderstatus").alias("source_platform"),
            F.concat(F.replace(F.col("o_orderdate").cast("string"), F.lit(" "), F.lit("T")), F.lit("+08:00")).alias("created_at"),
        )

    @cached_property
    def dim(self) -> DataFrame:
        nation = F.col("s_nationkey")
        return self.table("supplier").select(
            F.col("s_suppkey").alias("project_id"), F.col("s_name").alias("project_name"),
            F.concat(F.lit("L"), nation % 5).alias("language"), F.concat(F.lit("N"), nation).alias("org_name"),
            F.when(nation % 2 == 0, "gitee").otherwise("github").alias("source_platform"),
        )

    @cached_property
    def parts(self) -> int:
        return parts_for(self.table("lineitem"))

    @cached_property
    def fact(self) -> DataFrame:
        # Dealt by project and day first, so that a project of many lines is many tasks' work, then by project, as
        # the rollups need them. Nothing is aggregated ahead of the first, where a task has the lines of a whole split.
        lines = self.table("lineitem").select(
            F.col("l_suppkey").alias("project_id"), F.col("l_shipdate").cast("date").alias("snapshot_date"),
            "l_quantity", "l_linenumber", (F.col("l_returnflag") == "R").alias("returned"),
        )
        days = spread(lines, self.parts, "project_id", "snapshot_date").groupBy("project_id", "snapshot_date").agg(
            F.max("l_quantity").cast("long").alias("stars_count"),
            F.max("l_linenumber").cast("long").alias("forks_count"),
            F.count(F.when(F.col("returned"), 1)).alias("open_issues_count"),
        )
        days = spread(days, self.parts, "project_id")
        return days.join(self.dim.select("project_id", "org_name", "source_platform"), "project_id").select(
            "project_id", "org_name", "source_platform", "snapshot_date", "stars_count", "forks_count",
            "open_issues_count",
        )


class Documents(Tables):
    """Documents as raw records, with nulls and blanks put in by id."""

    SQL = """WITH fx_raw AS (
  SELECT doc_id AS repo_id, source AS org, source || '/' || doc_id AS full_name,
         CASE WHEN doc_id % 5 = 0 THEN NULL
              WHEN doc_id % 5 = 1 AND doc_id % 2 = 0 THEN '' ELSE text END AS description,
         CASE WHEN doc_id % 4 = 0 THEN '' ELSE lang END AS language,
         CASE doc_id % 4 WHEN 0 THEN 'gitee' WHEN 1 THEN 'github' WHEN 2 THEN 'unknown' ELSE NULL END
           AS source_platform,
         doc_id % 3 = 0 AS archived, CAST(n_chars AS INT) AS stars_count
  FROM documents)"""

    @cached_property
    def raw(self) -> DataFrame:
        doc = F.col("doc_id")
        return self.table("documents").select(
            doc.alias("repo_id"), F.col("source").alias("org"),
            F.concat("source", F.lit("/"), doc).alias("full_name"),
            F.when(doc % 5 == 0, None).when((doc % 5 == 1) & (doc % 2 == 0), "").otherwise(F.col("text"))
            .alias("description"),
            F.when(doc % 4 == 0, "").otherwise(F.col("lang")).alias("language"),
            F.when(doc % 4 == 0, "gitee").when(doc % 4 == 1, "github").when(doc % 4 == 2, "unknown")
            .alias("source_platform"),
            (doc % 3 == 0).alias("archived"), F.col("n_chars").cast("int").alias("stars_count"),
        )


class Audit(Tables):
    """Events as an audit log."""

    SQL = """WITH fx_log AS (
  SELECT event_id AS log_id, 'u' || user_id AS username, event_type AS action, props AS detail,
         ts AS create_time
  FROM events)"""

    @cached_property
    def log(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("log_id"), F.concat(F.lit("u"), "user_id").alias("username"),
            F.col("event_type").alias("action"), F.col("props").alias("detail"), F.col("ts").alias("create_time"),
        )
