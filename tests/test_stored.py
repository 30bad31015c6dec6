"""Results kept in their order, keyword pruning, the tree of the keyword pick, and the trend's one scan."""
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import TESTDATA, land, record, rows_of
from test_warehouse import DAYS, load

from repodw.checks.bindings import Lines
from repodw.operators import filters, paging, spread, stored
from repodw.plans import ads, dws, serve
from repodw.sources import selection


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """38,000 rows with ties and nulls, kept in 8 ranges and more, a folder each."""
    path = str(tmp_path_factory.mktemp("kept"))
    rows = spark.range(38_000).select(
        F.col("id"), F.when(F.col("id") % 50 != 0, F.col("id") % 7).alias("stars"),
        F.concat(F.lit("org"), F.col("id") % 10, F.lit("/Repo"), F.when(F.col("id") % 9500 == 0, F.lit("Ünique")).otherwise(F.lit("x"))).alias("name"))
    order = [("stars", False), ("id", True)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        stored.in_order(rows, order).write.parquet(f"{path}/raw")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    raw = spark.read.parquet(f"{path}/raw")
    ranges = stored.ranges_of(raw)
    stored.numbered(raw, ranges).write.partitionBy("range_no").parquet(f"{path}/rows")
    stored.grams_of(raw, ["name"]).write.parquet(f"{path}/grams")
    return rows, order, spark.read.parquet(f"{path}/rows"), ranges, spark.read.parquet(f"{path}/grams")


@pytest.mark.parametrize("page", [-1, 1, 2, 950, 1900, 5000])
def test_any_page_is_one_read_of_a_range(spark, kept, page):
    rows, order, stored_rows, ranges, _ = kept
    assert ranges.count() > 6
    found = stored.page_of(stored_rows, ranges, page, 20)
    plan = physical(found)
    assert "Exchange" not in plan and "TakeOrderedAndProject" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*range_no", plan) and re.search(r"PushedFilters: \[[^\]]*row_no", plan)
    expected = paging.page_rows(rows, order, page, 20)
    columns = ["row_no", "id", "stars", "name", "total_rows", "total_pages"]
    assert [tuple(r) for r in found.select(*columns).collect()] == [tuple(r) for r in expected.select(*columns).collect()]
    assert dict(found.dtypes) == dict(expected.dtypes)


@pytest.mark.parametrize("keyword", ["ünique", "Ü", "po", "g3/RE", "nothing here", "x"])
def test_keyword_reads_only_ranges_that_hold_its_grams(kept, keyword):
    rows, _, stored_rows, ranges, grams = kept
    some = stored_rows.filter(F.col("range_no").isin(stored.ranges_with(grams, [keyword])))
    found = filters.keyword_contains(some, ["name"], keyword)
    assert rows_of(found, "id") == rows_of(filters.keyword_contains(rows, ["name"], keyword), "id")
    read = some.select("range_no").distinct().count()
    # 4 rows hold the rare word; nothing is read for a word that none holds.
    assert read <= {"ünique": 4, "Ü": 4, "nothing here": 0}.get(keyword, ranges.count())


def test_literal_runs_of_patterns():
    assert stored.literal_runs("abc") == ["abc"] and stored.literal_runs("a%b_c") == ["a", "b", "c"]
    assert stored.literal_runs(r"a\%b\\_c") == ["a%b\\", "c"] and stored.literal_runs("%_") == []
    assert stored.literal_runs("ab\\") == ["ab%"]  # the last backslash takes the closing wildcard


def test_like_on_kept_rows_equals_like(kept):
    rows, _, stored_rows, _, grams = kept
    for keyword in ("G3/%ün_que", "_", "%", r"\_", "o%X", "zz%"):
        runs = stored.literal_runs(keyword)
        some = stored_rows.filter(F.col("range_no").isin(stored.ranges_with(grams, runs))) if runs else stored_rows
        assert filters.keyword_like(some, ["name"], keyword).count() == filters.keyword_like(rows, ["name"], keyword).count(), keyword


def test_warehouse_pages_of_kept_details(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    land(raw, "github", DAYS[0], [record(k, stars_count=k % 13, full_name=f"org/r{k}") for k in range(60)])
    land(raw, "github", DAYS[1], [record(k, stars_count=k % 11, full_name=f"org/R{k}") for k in range(50)])
    warehouse = load(spark, str(raw), tmp_path / "w", DAYS[:2])
    kept = [warehouse.latest(t) for t in ("ads_repo_details", "ads_repo_ranges", "ads_repo_grams")]
    fact, dim = warehouse.latest("fact_repo_stats"), warehouse.read("dim_project")
    for keyword, page in ((None, 1), ("", 3), ("r4", 1), ("R4", 2), (" 49 ", 1), ("none", 1)):
        found = serve.kept_search_page(*[df.drop("stat_date") for df in kept], keyword, page, 5)
        expected = serve.q_search_page(fact, dim, keyword, page, 5)
        assert [tuple(r) for r in found.select(*expected.columns).collect()] == [tuple(r) for r in expected.collect()], keyword
    assert warehouse.partitions("ads_repo_details") == DAYS[1:2]


def test_keyword_pick_meets_in_a_tree(spark):
    """Many tasks: the best of each keyword are those of a plain ranking, null and repeated ties included."""
    draw = random.Random(3)
    rows = [(draw.choice([None, k, k // 2]), draw.choice(["a go tool", "python", "go python", "none"]), draw.randrange(40)) for k in range(4000)]
    df = spark.createDataFrame(rows, "repo_id long, name string, stars_count int").repartition(200)
    found = selection.keyword_pick(df, ["go", "Python"], ["name"], rows=30)
    plan = physical(found)
    assert plan.count("WindowGroupLimit") >= 6 and found.columns == [*df.columns, "keyword"]
    for keyword in ("go", "Python"):
        expected = sorted((-s, (i is not None, i or 0)) for i, n, s in rows if keyword.lower() in n)[:30]
        mine = sorted((-r["stars_count"], (r["repo_id"] is not None, r["repo_id"] or 0)) for r in found.filter(F.col("keyword") == keyword).collect())
        assert mine == expected


def test_trend_reads_the_facts_once(spark):
    lines = Lines(spark, f"{TESTDATA}/sf0.001")
    months = ads.monthly_once(lines.fact, lines.dim)
    assert physical(months).count("lineitem.parquet") == 1
    from repodw.plans import dws

    plain = ads.monthly(dws.project_daily(lines.fact), dws.org_daily(lines.fact), dws.platform_daily(lines.fact, lines.dim.drop("org_name")))
    assert rows_of(months, *sorted(months.columns)) == rows_of(plain, *sorted(months.columns)) != []


def test_trend_of_unknown_projects_gaps_and_nulls(spark):
    from helpers import facts
    from repodw.plans import dws

    fact = facts(spark, [(1, 1, 5, 1, 0), (1, 2, None, 1, 2), (1, 5, 9, 1, 0), (2, 2, 7, 1, 1), (9, 30, 50, 1, 1), (9, 31, 51, 1, 0),
                         (3, 2, 1, 1, 0, "a", "github"), (3, 2, 4, 1, 0, "b", "github"), (3, 3, 6, 1, 3, "b", "gitee")])
    dim = spark.createDataFrame([(1, "Go", "github"), (2, "C", "gitee"), (3, "C", "gitee")], "project_id long, language string, source_platform string")
    plain = ads.monthly(dws.project_daily(fact), dws.org_daily(fact), dws.platform_daily(fact, dim))
    assert rows_of(ads.monthly_once(fact, dim), *sorted(plain.columns)) == rows_of(plain, *sorted(plain.columns))


def test_facts_of_lines_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    """No task has more than a share of the days of projects, where Spark alone joins all partitions into one."""
    monkeypatch.setattr(spread, "ROWS_PER_TASK", 100)
    rows = [(p, datetime(2024, 1, 1) + timedelta(d), float(d % 7), d % 3, "R" if d % 2 else "N") for p in range(200) for d in range(20)]
    rows += [(None, datetime(2024, 1, 1), 1.0, 1, "N"), (1, None, 1.0, 1, None)]
    spark.createDataFrame(rows, "l_suppkey long, l_shipdate timestamp, l_quantity double, l_linenumber int, l_returnflag string"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(p, f"s{p}", p % 25) for p in range(200)], "s_suppkey long, s_name string, s_nationkey int"
                          ).write.parquet(f"{tmp_path}/supplier.parquet")
    lines = Lines(spark, str(tmp_path))
    assert lines.parts == 41
    for daily in (lines.fact, dws.project_daily(lines.fact)):
        counts = daily.groupBy(F.spark_partition_id()).count().collect()
        assert sum(n for _, n in counts) == 4001 and max(n for _, n in counts) <= 400
    months = ads.monthly_once(lines.fact, lines.dim, lines.parts)
    assert rows_of(months, *sorted(months.columns)) == rows_of(ads.monthly_once(lines.fact, lines.dim), *sorted(months.columns))
