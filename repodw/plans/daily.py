"""Days from raw files to marts, one or many at once, and the refresh of a whole warehouse."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from contextlib import ExitStack
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repodw import schemas
from repodw.operators.keyed import upsert
from repodw.operators import stored
from repodw.plans import ads, clean, dwd, dws, serve
from repodw.session import written_for_now
from repodw.sources import landing
from repodw.sources.raw import file_of, raw_order, read_raw_json
from repodw.sources.store import Warehouse


DAY_MARTS = ["ads_overview", "ads_project_ranking", "ads_language_dist", "ads_org_compare"]


def run_day(spark: SparkSession, raw_dir: str, warehouse: Warehouse, day: str,
            schema: T.StructType = schemas.RAW, undated: bool = False) -> None:
    """Load one day. Running a day again gives the same tables; a late day repairs the day after it.

    Files whose path names no day belong to the day they were first loaded with: with `undated` new ones are given this
    day, otherwise they are an error.
    """
    run_days(spark, raw_dir, warehouse, [day], schema, day if undated else None)


def run_days(spark: SparkSession, raw_dir: str, warehouse: Warehouse, days: Iterable[str] | None = None,
             schema: T.StructType = schemas.RAW, undated_day: str | None = None, names: str = "*.json") -> None:
    """Load any number of days, by default all that landed files belong to, in one go: each layer is one job over all
    days. The tables are those that loading the days one by one in their order gives."""
    files = landing.dated(landing.listed(spark, raw_dir, names), warehouse.read("landed_files"), undated_day)
    with written_for_now(files, "landed") as files:
        landing.refuse_undated(files)
        if days is None:
            # One value per calendar day: a bounded list.
            days = [row["dt"] for row in files.select("dt").distinct().collect()]
        days = sorted(set(days))
        if days:
            with warehouse.loading():
                load_files(spark, raw_dir, warehouse, files, days, schema)
                refresh_days(warehouse, days)


def load_files(spark: SparkSession, raw_dir: str, warehouse: Warehouse, files: DataFrame, days: Sequence[str],
               schema: T.StructType = schemas.RAW) -> None:
    """Clean the records of all files of some days, those of landing.dated() and those of the ledger, replace these days of
    the raw layer, and enter the files into the ledger."""
    mine = landing.files_of(warehouse, files, days)
    ledger = spark.createDataFrame(mine, "file string, dated boolean, dt string")
    with warehouse.loading():
        warehouse.replace_days("landed_files", ledger, days)
        if not mine:
            empty = spark.createDataFrame([], schemas.TABLES["ods_repos_raw"])
            warehouse.replace_days("ods_repos_raw", empty, days)
            return
        raw = read_raw_json(spark, raw_dir, schema, files=[file for file, *_ in mine])
        given = raw.withColumn("file", file_of(F.col("file_name"))).join(ledger.select("file", "dt"), "file")
        rows = clean.clean_repos(given, raw_order(), within=["dt"])
        # The deduplication has spread one day's rows already; many days are gathered by day.
        warehouse.replace_days("ods_repos_raw", clean.normalize_ods(rows), days, rebalance=len(days) > 1)


def load_ods(warehouse: Warehouse, raw: DataFrame, day: str) -> None:
    """Clean the raw records of a day and replace its raw-layer partition."""
    rows = clean.clean_repos(raw, raw_order())
    # The deduplication has spread the rows already; writing needs no further shuffle.
    warehouse.replace_days("ods_repos_raw", clean.normalize_ods(rows, day), [day], rebalance=False)


def refresh_day(warehouse: Warehouse, day: str) -> None:
    refresh_days(warehouse, [day])


def refresh_days(warehouse: Warehouse, days: Sequence[str]) -> None:
    """Carry loaded days through the star schema, the rollups and the marts, published together at the end."""
    last, before = warehouse.newest_partition("ods_repos_raw"), warehouse.newest_partition("fact_repo_stats")
    if last is None:
        raise ValueError("the raw layer is empty; load a day first")
    # Days before the newest one are late: they know older attributes.
    late = [day for day in days if before is not None and day < before]
    old_dim, old_orgs = warehouse.read("dim_project"), warehouse.read("dim_org")
    with warehouse.loading(), ExitStack() as stack:
        rows = stack.enter_context(written_for_now(dwd.project_rows(_ods(warehouse, days), ["dt"]), "projects"))
        changes = stack.enter_context(written_for_now(dwd.changed_projects(old_dim, dwd.last_rows(rows, late)), "changes"))
        dim = load_star(warehouse, changes, days)
        went = warehouse.read_days("dws_project_daily", _with_next(days))
        refresh_rollups(warehouse, days)
        refresh_attribute_rollups(warehouse, dim, changes.filter("restate"), days)
        warehouse.settle()
        refresh_months(warehouse, days, went)
        for day in [d for d in days if d not in late][:-1]:
            # A mart keeps what was known on its day.
            known = dwd.last_rows(rows.filter(F.col("dt") <= day), late)
            dim_then = upsert(old_dim.drop("etl_time"), dwd.changed_projects(old_dim, known).select(*[c for c in old_dim.columns if c != "etl_time"]), ["project_id"])
            then = dwd.one_org_name(_ods(warehouse, [d for d in days if d <= day]), warehouse.read("dim_org"), warehouse.collation)
            orgs_then = old_orgs.select("org_name", "source_platform").union(dwd.distinct_orgs(then))
            write_marts(warehouse, day, dim_then, orgs_then.distinct(),
                        dws.language_daily(warehouse.read_days("fact_repo_stats", [day]), dim_then, warehouse.collation))
        refresh_marts(warehouse)


def load_star(warehouse: Warehouse, changes: DataFrame, days: Sequence[str]) -> DataFrame:
    """Facts and dimensions of some days. Returns the staged project dimension, of which only the buckets with `changes`
    (changed_projects) are written again."""
    # At most one value per bucket.
    buckets = [r["b"] for r in changes.select(warehouse.bucket_of(F.col("project_id")).alias("b")).distinct().collect()]
    old = warehouse.read("dim_project", buckets)
    dim = warehouse.stage_buckets("dim_project", upsert(old, changes.select(*[c for c in old.columns if c != "etl_time"]), ["project_id"]), buckets)
    ods = _ods(warehouse, days)
    warehouse.append_unseen("dim_org", dwd.distinct_orgs(ods, warehouse.collation))
    named = dwd.one_org_name(ods, warehouse.read("dim_org"), warehouse.collation)
    warehouse.replace_days("fact_repo_stats", dwd.fact_rows(named), days)
    return dim


def _ods(warehouse: Warehouse, days: Sequence[str]) -> DataFrame:
    """The raw layer of some days, platforms under one name."""
    return dwd.one_platform_name(warehouse.read_days("ods_repos_raw", days), warehouse.collation)


def refresh_rollups(warehouse: Warehouse, days: Sequence[str]) -> None:
    """Project and organisation rollups of these days and the next ones, whose changes look back to them."""
    touched = _with_next(days)
    near = warehouse.read_days("fact_repo_stats", {*touched, *[_shift(day, -1) for day in touched]})
    mine = F.col("snapshot_date").isin([date.fromisoformat(day) for day in touched])
    warehouse.replace_days("dws_project_daily", dws.project_daily(near).filter(mine), touched)
    warehouse.replace_days("dws_org_daily", dws.org_daily(near).filter(mine), touched)


def moved_facts(warehouse: Warehouse, moved: DataFrame, days: Sequence[str]) -> DataFrame:
    """Facts of other days in the buckets of some projects; other buckets are not read."""
    buckets = [r["b"] for r in moved.select(warehouse.bucket_of(F.col("project_id")).alias("b")).distinct().collect()]
    return warehouse.read("fact_repo_stats", buckets).filter(~F.col("snapshot_date").isin([date.fromisoformat(d) for d in days]))


def refresh_attribute_rollups(warehouse: Warehouse, dim: DataFrame, moved: DataFrame, days: Sequence[str]) -> None:
    """Language and platform rollups of these days, and of those on which a changed project has facts.

    History counts under the present dimension. Instead of counting it again, the changed projects are moved within the
    stored cube, of which only the days they have facts on are read and written; of the facts, only their buckets.
    """
    parts = dws.attribute_daily(warehouse.read_days("fact_repo_stats", days), dim)
    with ExitStack() as stack:
        restated: list[str] = []
        if not moved.isEmpty():
            moves = stack.enter_context(written_for_now(dws.attribute_moves(moved_facts(warehouse, moved, days), moved), "moves"))
            # At most one value per calendar day, so the driver holds a bounded list.
            restated = [row["snapshot_date"].isoformat() for row in moves.select("snapshot_date").distinct().collect()]
            parts = parts.unionByName(moves).unionByName(warehouse.read_days("dws_attribute_daily", restated))
        touched = sorted({*restated, *days})
        warehouse.replace_days("dws_attribute_daily", dws.add_up(parts), touched)
    _write_attribute_rollups(warehouse, touched)


def _write_attribute_rollups(warehouse: Warehouse, days: Sequence[str] = ()) -> None:
    """From the cube, for some days or all."""
    cube = warehouse.read_days("dws_attribute_daily", days) if days else warehouse.read("dws_attribute_daily")
    warehouse.replace_days("dws_language_daily", dws.language_of(cube, warehouse.collation), days, whole=not days)
    warehouse.replace_days("dws_platform_daily", dws.platform_of(cube), days, whole=not days)


def rebuild_rollups(warehouse: Warehouse) -> None:
    """All rollups from all facts."""
    fact, dim = warehouse.read("fact_repo_stats"), warehouse.read("dim_project")
    with warehouse.loading():
        warehouse.replace_days("dws_project_daily", dws.project_daily(fact), whole=True)
        warehouse.replace_days("dws_org_daily", dws.org_daily(fact), whole=True)
        warehouse.replace_days("dws_attribute_daily", dws.attribute_daily(fact, dim), whole=True)
        _write_attribute_rollups(warehouse)


def _shift(day: str, by: int) -> str:
    return (date.fromisoformat(day) + timedelta(by)).isoformat()


def _with_next(days: Sequence[str]) -> list[str]:
    return sorted({*days, *[_shift(day, 1) for day in days]})


def refresh_months(warehouse: Warehouse, days: Sequence[str], went: DataFrame) -> None:
    """Month sums of the months these days touch, and the creation months of the days' raw rows. `went` are the project
    rollups of the days and the next ones before this load.

    What a month keeps per project changes by the difference between the days' rollups before and now. Only for projects
    whose best total went with a day are other days of the month read. Moving a project to another platform changes no
    sum over all platforms, so restated days do not count.
    """
    touched = _with_next(days)
    months = sorted({day[:7] for day in touched})
    came = warehouse.read_days("dws_project_daily", touched)
    state = warehouse.read_days("dws_project_month", months)
    update = ads.project_month_update(state, ads.project_month_rows(came), ads.project_month_rows(went, -1))
    with written_for_now(update, "months") as update:
        rows = update.drop("open")
        if not (lost := update.filter("open")).isEmpty():
            rows = update.filter("NOT open").drop("open").unionByName(_months_again(warehouse, lost, months))
        warehouse.replace_days("dws_project_month", rows, months)
    org, platform = (warehouse.read_days(t, touched) for t in ("dws_org_daily", "dws_platform_daily"))
    others = warehouse.read_days("dws_day_sums", months).filter(~F.col("snapshot_date").isin([date.fromisoformat(d) for d in touched]))
    warehouse.replace_days("dws_day_sums", others.unionByName(ads.day_sums(org, platform).select(*others.columns)), months)
    sums = ads.monthly_of(warehouse.read_days("dws_project_month", months), warehouse.read_days("dws_day_sums", months))
    warehouse.replace_days("dws_monthly", sums, months)
    created = ads.created_by_month(warehouse.read_days("ods_repos_raw", days), by=["dt"])
    warehouse.replace_days("dws_created_monthly", created, days)


def _months_again(warehouse: Warehouse, lost: DataFrame, months: Sequence[str]) -> DataFrame:
    """The months of some projects from all days."""
    days = warehouse.read_days("dws_project_daily", [d for d in warehouse.partitions("dws_project_daily") if d[:7] in months])
    again, lost = ads.project_month_rows(days), lost.select(F.col("stat_month").alias("_month"), F.col("project_id").alias("_id"))
    return again.join(lost, (F.col("stat_month") == F.col("_month")) & F.col("project_id").eqNullSafe(F.col("_id")), "left_semi")


def rebuild_months(warehouse: Warehouse) -> None:
    """All month sums from all rollups and raw rows."""
    project, org, platform = (
        warehouse.read(t) for t in ("dws_project_daily", "dws_org_daily", "dws_platform_daily")
    )
    with warehouse.loading():
        warehouse.replace_days("dws_project_month", ads.project_month_rows(project), whole=True)
        warehouse.replace_days("dws_day_sums", ads.day_sums(org, platform), whole=True)
        sums = ads.monthly_of(warehouse.read("dws_project_month"), warehouse.read("dws_day_sums"))
        warehouse.replace_days("dws_monthly", sums, whole=True)
        created = ads.created_by_month(warehouse.read("ods_repos_raw"), by=["dt"])
        warehouse.replace_days("dws_created_monthly", created, whole=True)


def refresh_marts(warehouse: Warehouse) -> None:
    """The marts of the newest snapshot day, and the monthly trend. Without facts nothing is written.

    Marts of days beyond the newest fact, which were loaded once and then emptied, are removed.
    """
    last = warehouse.newest_partition("fact_repo_stats")
    with warehouse.loading():
        for table in DAY_MARTS:
            for day in warehouse.partitions(table):
                if last is None or day > last:
                    warehouse.drop_partition(table, day)
        if last is None:
            return
        write_marts(warehouse, last, warehouse.read("dim_project"), warehouse.read("dim_org"), warehouse.read_days("dws_language_daily", [last]))
        keep_details(warehouse, last)
        months = warehouse.read("dws_monthly")
        history = ads.monthly_trend_history(warehouse.read("dws_created_monthly"), months)
        trend = ads.monthly_trend_merged(ads.monthly_trend_snapshots(months), history)
        warehouse.replace_days("ads_monthly_trend", trend, whole=True)


def write_marts(warehouse: Warehouse, day: str, dim: DataFrame, orgs: DataFrame, language: DataFrame) -> None:
    """The marts of one day."""
    on = date.fromisoformat(day)
    fact, project, org = (warehouse.read_days(t, [day]) for t in ("fact_repo_stats", "dws_project_daily", "dws_org_daily"))
    warehouse.replace_days("ads_overview", ads.overview(dim, fact, on))
    warehouse.replace_days("ads_project_ranking", ads.project_ranking(project, dim, fact, on))
    warehouse.replace_days("ads_language_dist", ads.language_dist(language, on))
    warehouse.replace_days("ads_org_compare", ads.org_compare(org, orgs, on))


def keep_details(warehouse: Warehouse, day: str) -> None:
    """The newest day's detail rows in their order, with the counts and grams of its ranges."""
    details = serve.kept_details(warehouse.read_days("fact_repo_stats", [day]), warehouse.read("dim_project"))
    with written_for_now(details, "details") as rows:
        on, ranges = F.lit(date.fromisoformat(day)).alias("stat_date"), stored.ranges_of(rows)
        warehouse.replace_days("ads_repo_details", stored.numbered(rows, ranges).select("*", on), whole=True)
        warehouse.replace_days("ads_repo_ranges", ranges.select("*", on), whole=True)
        warehouse.replace_days("ads_repo_grams", stored.grams_of(rows, serve.DETAIL_KEYWORD_COLUMNS).select("*", on), whole=True)
