"""What the physical plans must and must not contain."""
import re

import pytest
from pyspark.sql import functions as F

from helpers import TESTDATA, plan_of

import __spark_entry__ as entry
from repodw.checks import registry
from repodw.checks.bindings import Documents, Events
from repodw.operators import topk
from repodw.operators.dedup import keep_one
from repodw.operators.latest import latest_snapshot
from repodw.operators.median import exact_median
from repodw.plans import ads, clean, dws
from repodw.sources import selection
from repodw.sources.store import Warehouse

FOLDER = f"{TESTDATA}/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_every_plan(spark, name):
    """No Python, no product joins; whatever gathers rows in one task has been cut to partial aggregates or a limit
    right below."""
    df = entry.queries()[name](spark, FOLDER)
    plan = plan_of(df)
    for word in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct",
                 "BroadcastNestedLoopJoin", "Cross"):
        assert word not in plan, word
    lines = physical(df).splitlines()
    for i, line in enumerate(lines):
        # The median gathers its value blocks, at most 65,536.
        if "Exchange SinglePartition" in line and name != "prof_totals":
            below = next(x for x in lines[i + 1:] if "Subquery" not in x)
            assert re.search(r"partial_|HashAggregate|LocalLimit|TakeOrdered|SortAggregate|ObjectHashAggregate", below), below


def test_ordered_dedup_cuts_before_the_shuffle(spark):
    df = Documents(spark, FOLDER).raw
    plan = physical(keep_one(df, ["repo_id"], ["full_name"]))
    partial, exchange = plan.index(", 1, Partial"), plan.index("Exchange hashpartitioning")
    assert exchange < partial  # a plan prints its input below


def test_keyword_pick_cuts_before_the_shuffle(spark):
    plan = physical(selection.keyword_pick(Documents(spark, FOLDER).raw, ["a"], ["full_name"]))
    assert "500, Partial" in plan


@pytest.mark.parametrize("name", ["topn_projects", "ads_project_ranking", "latest_log_rows", "compare_pool", "prof_top15",
                                  "topn_orgs", "topn_languages", "page_rows", "peak_point", "latest_row"])
def test_top_k_takes_k_rows_per_task(spark, name):
    assert "TakeOrderedAndProject" in physical(entry.queries()[name](spark, FOLDER))


def test_median_windows_see_bounded_rows(spark):
    df = spark.range(10).select(F.col("id").cast("int").alias("v"))
    plan = plan_of(df.limit(1).select(exact_median(df, "v")))
    assert "hashpartitioning(v" in plan  # values are counted over all tasks first


def test_newest_day_is_pushed_into_the_scan(spark):
    events = Events(spark, FOLDER)
    plan = physical(latest_snapshot(events.fact))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,2024-01-30", plan)
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>", plan)


def test_columns_are_pruned(spark):
    plan = physical(dws.project_daily(Events(spark, FOLDER).fact).select("project_id", "total_cum_stars"))
    assert "event_type" not in plan
    plan = physical(clean.fill_language(Documents(spark, FOLDER).raw).select("repo_id", "language"))
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


def test_project_daily_partially_aggregates_and_sorts_only_keys(spark):
    plan = physical(dws.project_daily(Events(spark, FOLDER).fact))
    assert "Join" in plan and "SortMergeJoin" not in plan
    assert plan.count("Window") >= 1 and "Exchange SinglePartition" not in plan


def test_watch_list_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "orgs")
    Events(spark, FOLDER).fact.select("org_name", "source_platform").write.parquet(path)
    plan = physical(selection.track_orgs(spark.read.parquet(path), {"gitee": ["a"], "github": ["b"]}, org="org_name"))
    assert re.search(r"PushedFilters: \[Or\(", plan)


def test_warehouse_reads_prune_partitions(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    events = Events(spark, FOLDER)
    warehouse.replace_days("dws_project_daily", dws.project_daily(events.fact))
    plan = physical(ads.on_day(warehouse.read("dws_project_daily"), events.last))
    assert re.search(r"PartitionFilters: \[[^\]]*snapshot_date[^\]]* = 2024-01-30", plan)
    newest = warehouse.latest("dws_project_daily")
    assert all("snapshot_date=2024-01-30" in file for file in newest.inputFiles()) and newest.count() == 14
    assert warehouse.read_days("dws_project_daily", ["1999-01-01"]).isEmpty()


def test_counts_need_no_expand(spark):
    events = Events(spark, FOLDER)
    for df in (dws.platform_daily(events.fact, events.projects), ads.overview(events.projects, events.fact, events.last)):
        assert "Expand" not in physical(df)


def test_fold_reads_twice_and_has_no_window(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("g"), "id")
    assert "Window" not in physical(topk.top_and_rest(df, "g", "id", ["id"]))
