import random

import pytest
from pyspark.sql import functions as F

from helpers import facts, projects, rows_of

from repodw import fixed_values as V
from repodw.operators import filters, paging, topk
from repodw.operators.median import exact_median
from repodw.plans import profile, serve
from repodw.sources import calendar, export


@pytest.fixture(scope="module")
def shop(spark):
    fact = facts(spark, [(p, 2, 100 - p, p, p % 3) for p in range(1, 26)] + [(1, 1, 1, 1, 1)])
    return fact, projects(spark, [(p, f"org/r{p}", f"L{p % 9}", "gitee" if p % 2 else "github") for p in range(1, 26)])


def test_page_past_the_end_is_the_last_page(shop):
    rows = serve.q_search_page(*shop, keyword="", page=9, size=10).collect()
    assert [r.row_no for r in rows] == [21, 22, 23, 24, 25]
    assert {(r.total_rows, r.total_pages) for r in rows} == {(25, 3)}


def test_page_of_nothing(shop):
    assert serve.q_search_page(*shop, keyword="nowhere", page=3, size=10).count() == 0


@pytest.mark.parametrize("order", [[("v", False), ("id", True)], [("v", True), ("id", False)]])
def test_deep_pages_equal_a_full_sort(spark, order):
    rng = random.Random(7)
    data = [(i, rng.choice([None, 0, 0, 0, rng.randint(0, 50)])) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, v int").repartition(4)
    keys = [F.col(c).asc() if up else F.col(c).desc() for c, up in order]
    everything = [r.id for r in df.orderBy(*keys).collect()]
    for page in (2, 57, 100, 150, 300):
        found = paging.page_rows(df, order, page, 20).orderBy("row_no").collect()
        first = (min(page, 150) - 1) * 20
        assert [r.id for r in found] == everything[first:first + 20]
        assert [r.row_no for r in found] == list(range(first + 1, first + 21))


def test_deep_page_without_a_total_order_still_ends(spark):
    df = spark.range(500).select(F.lit(1).alias("v"), "id")
    assert paging.page_rows(df, [("v", True)], 10, 20).count() == 20


def test_like_has_wildcards_and_contains_has_none(spark):
    df = spark.createDataFrame([("50%_x",), ("50 percent",), ("5000",), (None,)], "c string")
    assert filters.keyword_like(df, ["c"], "50%_").count() == 3
    assert filters.keyword_like(df, ["c"], "50%_", literal=True).count() == 1
    assert filters.keyword_contains(df, ["c"], " 50%_ ").count() == 1
    assert filters.keyword_contains(df, ["c"], "  ").count() == 4
    assert filters.equals_filter(df, "c", "  ").count() == 0
    assert filters.equals_filter(df, "c", " 5000 ").count() == 1


@pytest.mark.parametrize("keyword, literal, found", [
    ("a\\b", False, ["ab"]), ("a\\b", True, ["a\\b"]), ("\\%", False, ["5%"]), ("5%", True, ["5%"]), ("\\_", True, ["\\_"]),
    ("\\\\", False, ["\\_", "a\\b"]), ("5\\", False, ["5%"])])
def test_like_escapes(spark, keyword, literal, found):
    df = spark.createDataFrame([("ab",), ("a\\b",), ("5%",), ("\\_",)], "c string")
    assert [r.c for r in filters.keyword_like(df, ["c"], keyword, literal).orderBy("c").collect()] == sorted(found)


def test_equals_with_collation(spark):
    df = spark.createDataFrame([("openEuler",), ("OPENEULER",)], "c string")
    assert filters.equals_filter(df, "c", "openeuler").count() == 0
    assert filters.equals_filter(df, "c", "openeuler", "UNICODE_CI_AI").count() == 2


@pytest.mark.parametrize("groups", [1, 7, 8, 20])
def test_fold(spark, groups):
    df = spark.createDataFrame([(f"g{i:02}", i, None if i == 0 else i) for i in range(groups)], "g string, n int, s int")
    folded = {r.g: r.n for r in topk.top_and_rest(df, "g", "n", ["n", "s"]).collect()}
    assert len(folded) == min(groups, 8)
    assert sum(folded.values()) == sum(range(groups))
    assert folded.get(V.REST_LABEL) == (sum(range(groups - 7)) if groups > 7 else None)


def test_fold_keeps_a_group_that_is_called_like_the_rest(spark):
    df = spark.createDataFrame([(V.REST_LABEL, 100)] + [(f"g{i}", i) for i in range(9)], "g string, n int")
    assert sorted(r.n for r in topk.top_and_rest(df, "g", "n", ["n"]).collect() if r.g == V.REST_LABEL) == [3, 100]


def test_fold_with_ties_and_equal_labels(spark):
    df = spark.createDataFrame([("same", 5, i) for i in range(10)], "g string, n int, id int")
    rows = topk.top_and_rest(df, "g", "n", ["n"], ties=["id"]).collect()
    assert sorted((r.g, r.n) for r in rows) == sorted([("same", 5)] * 7 + [(V.REST_LABEL, 15)])


def test_compare(shop):
    rows = serve.q_compare(*shop).collect()
    assert sorted(r.fullName for r in rows) == ["org/r1", "org/r2", "org/r3"]
    assert {r.starsCount_max for r in rows} == {99}
    with pytest.raises(ValueError):
        serve.q_compare(*shop, names=[f"org/r{i}" for i in range(1, 8)])
    rows = serve.q_compare(*shop, names=["org/r3", "org/r21"], measure="openIssuesCount").collect()
    assert [(r.fullName, r.openIssuesCount_max, r.share) for r in rows] == [("org/r3", 1, None)]


def test_filter_view(spark):
    rows = spark.createDataFrame([(i, f"f{i}", f"L{i % 2}", 50 - i, "gitee") for i in range(1, 21)],
                                 "ranking int, fullName string, language string, starsCount int, platform string")
    assert serve.filter_view(rows, chart="bar").count() == 15
    assert serve.filter_view(rows, chart="line").count() == 20
    assert serve.filter_view(rows, chart="pie").count() == 8
    assert serve.filter_view(rows, "github").count() == 0
    assert serve.filter_view(rows, languages=["L1"], chart="line").count() == 10
    assert [r.language for r in serve.distinct_languages(rows.unionByName(
        rows.limit(1).withColumn("language", F.lit("")))).collect()] == ["L0", "L1"]


def test_org_drill_down(shop):
    assert [r.fullName for r in serve.q_org_repos(*shop, org="org1").limit(2).collect()] == ["org/r1", "org/r4"]
    assert serve.q_org_repos(*shop, org="").count() == 0
    row = serve.q_repos(*shop).first()
    assert (row.fullName, row.snapshotDate) == ("org/r1", "2024-01-02")


def test_audit(spark):
    log = spark.createDataFrame(
        [(i, f"u{i % 2}", "登录" if i % 3 else "导出", f"d{i}") for i in range(250)],
        "log_id long, username string, action string, detail string")
    assert serve.latest_log_rows(log).agg(F.min("log_id")).first()[0] == 50
    one = serve.audit_counts(log, "u1").first()
    assert (one.loginCount + one.exportCount, one.logCount) == (125, 125)
    nobody = serve.audit_counts(log, "nobody").first()
    assert tuple(nobody) == (0, 0, 0)
    page = serve.q_audit_log(log, "导出", "U1", page=1, size=10).collect()
    assert page[0].total_rows == len([i for i in range(50, 250) if i % 3 == 0 and i % 2 == 1])


def test_csv_has_mark_header_and_order(spark, shop, tmp_path):
    path = str(tmp_path / "csv")
    export.write_csv(export.export_rows(*shop, keyword="org/r1_"), path, single_file=True)
    lines = next((tmp_path / "csv").glob("part-*.csv")).read_text(encoding="utf-8").splitlines()
    assert lines[0] == "﻿仓库全名,组织,语言,平台,Star,Fork,Watch,Issues,统计日期"
    assert lines[1].startswith("org/r10,org1,L1,github,90,10,0,1,2024-01-02")
    assert len(lines) == 11


def test_calendar(spark):
    days = calendar.gen_dim_date(spark)
    assert days.count() == 7670
    assert days.agg(F.sum("is_weekend")).first()[0] == 2192
    row = days.filter("date_id = DATE '2024-01-07'").first()
    assert (row.day_of_week, row.is_weekend, row.week_of_year, row.quarter) == (7, 1, 1, 1)
    assert days.filter("date_id = DATE '2010-01-01'").first().week_of_year == 53


def test_star_bins(spark):
    df = spark.createDataFrame([(s,) for s in (0, 1, 9, 10, 999, 1000, -1, None)], "stars_count int")
    assert [(r.star_range, r.repos) for r in profile.prof_star_bins(df).orderBy("bin_no").collect()] == [
        ("0", 1), ("1-9", 2), ("10-49", 1), ("50-99", 0), ("100-499", 0), ("500-999", 1), ("1000+", 1)]


@pytest.mark.parametrize("values", [
    [], [5], [1, 2], [3, 3, 3, 9], [-70000, 70000], [-5, -4, 0, 2**31 - 1, -2**31], [0] * 1000 + [7],
    list(range(0, 400000, 997)), [65535, 65536], [-65536, -65537, -1, 0],
])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "stars_count int")
    ordered = sorted(values)
    n = len(ordered)
    expected = (ordered[(n - 1) // 2] + ordered[n // 2]) / 2 if n else None
    assert df.limit(1).select(exact_median(df, "stars_count").alias("m")).first().m == expected


def test_profile_drops_null_keys(spark):
    df = spark.createDataFrame(
        [(1, "o", "gitee", 5, 1, None, None), (2, None, None, 3, 1, "Go", "2020-12-31T20:00:00-08:00"),
         (3, "o", "gitee", 2, 1, V.NO_LANGUAGE, "x")],
        "repo_id long, org string, source_platform string, stars_count int, forks_count int, language string, "
        "created_at string")
    assert rows_of(profile.prof_platform(df), "source_platform", "repos", "with_language") == [("gitee", 2, 1)]
    assert rows_of(profile.prof_org(df), "org", "repos", "total_stars") == [("o", 2, 7)]
    assert rows_of(profile.prof_lang_top10(df), "language", "repos") == [("Go", 1), (V.NO_LANGUAGE, 1)]
    assert rows_of(profile.prof_year(df), "year", "repos") == [(2021, 1)]
