import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import facts, projects, rows_of

from repodw.operators import keyed, latest
from repodw.operators.delta import daily_with_delta
from repodw.plans import ads, dwd, dws


def day(n):
    return date(2024, 1, n)


def test_gap_day_gives_no_change(spark):
    daily = dws.project_daily(facts(spark, [(1, 1, 10, 1, 5), (1, 2, 13, 2, 4), (1, 4, 20, 3, 4)]))
    assert rows_of(daily, "snapshot_date", "curr_day_new_stars", "curr_day_new_forks", "curr_day_new_issues") == [
        (day(1), 0, 0, 0), (day(2), 3, 1, -1), (day(4), 0, 0, 0)]


def test_late_day_repairs_the_next(spark):
    daily = dws.project_daily(facts(spark, [(1, 1, 10, 1, 5), (1, 2, 13, 2, 4), (1, 4, 20, 3, 4), (1, 3, 15, 3, 4)]))
    assert rows_of(daily, "snapshot_date", "curr_day_new_stars")[2:] == [(day(3), 2), (day(4), 5)]


def test_drop_and_null_values(spark):
    daily = dws.project_daily(facts(spark, [(1, 1, 10, None, None), (1, 2, 8, 4, 3)]))
    assert rows_of(daily, "snapshot_date", "curr_day_new_stars", "curr_day_new_forks", "curr_day_new_issues") == [
        (day(1), 0, None, None), (day(2), -2, 0, 0)]


def test_duplicate_facts_count_by_maximum(spark):
    fact = facts(spark, [(1, 1, 10, 1, 5), (1, 1, 12, 1, 7), (1, 2, 15, 1, 9)])
    assert rows_of(dws.project_daily(fact), "snapshot_date", "total_cum_stars", "curr_day_new_stars", "curr_day_new_issues") == [
        (day(1), 12, 0, 0), (day(2), 15, 3, 2)]


def test_random_history_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(p, d, rng.randint(0, 9), rng.randint(0, 9), 0) for p in range(6) for d in range(1, 28) if rng.random() < 0.6
            for _ in range(rng.randint(1, 2))]
    best = {}
    for p, d, s, *_ in rows:
        best[p, d] = max(best.get((p, d), -1), s)
    expected = sorted(((p, day(d), s, s - best.get((p, d - 1), s)) for (p, d), s in best.items()), key=repr)
    daily = dws.project_daily(facts(spark, rows))
    assert rows_of(daily, "project_id", "snapshot_date", "total_cum_stars", "curr_day_new_stars") == expected


def test_changes_of_consecutive_days_add_up(spark):
    fact = facts(spark, [(1, d, d * d, 0, 0) for d in range(1, 11)])
    assert dws.project_daily(fact).agg(F.sum("curr_day_new_stars")).first()[0] == 100 - 1


def test_month_and_year_borders_are_neighbours(spark):
    df = spark.createDataFrame([("a", date(2023, 12, 31), 1), ("a", date(2024, 1, 1), 4)], "k string, d date, v long")
    assert rows_of(daily_with_delta(df, ["k"], "d", {"v": "c"}), "d", "c") == [
        (date(2023, 12, 31), 0), (date(2024, 1, 1), 3)]


def test_one_project_with_most_rows(spark):
    """A third and more of all fact rows belong to one project; sums and counts stay right."""
    rows = [(1, 1 + i % 5, i % 7, 1, 1) for i in range(3000)] + [(p, 1, 2, 1, 0) for p in range(2, 1002)]
    fact = facts(spark, rows)
    dim = projects(spark, [(p, f"f{p}", "Go", "github") for p in range(1, 1002)])
    first = dws.language_daily(fact, dim).filter("snapshot_date = DATE '2024-01-01'").first()
    assert (first.repo_count, first.total_stars) == (1001, sum(i % 7 for i in range(0, 3000, 5)) + 2000)
    platform = dws.platform_daily(fact, dim).filter("snapshot_date = DATE '2024-01-01'").first()
    assert (platform.repo_count, platform.active_projects) == (1001, 1)


def test_language_average_is_an_exact_decimal(spark):
    fact = facts(spark, [(1, 1, 1, 0, 0), (2, 1, 0, 0, 0), (3, 1, 0, 0, 0), (4, 1, None, 0, 0)])
    dim = projects(spark, [(p, "f", "Go", "github") for p in (1, 2, 3, 4)])
    row = dws.language_daily(fact, dim).first()
    assert (row.repo_count, row.avg_stars) == (4, Decimal("0.33"))


def test_half_cents_round_up(spark):
    fact = facts(spark, [(p, 1, 1 if p <= 43 else 0, 0, 0) for p in range(1, 41)] + [(41, 1, 3, 0, 0)])
    dim = projects(spark, [(p, "f", "Go", "github") for p in range(1, 42)])
    # 43 stars over 40 projects is 1.075 exactly, which a double cannot hold.
    fact = fact.filter("project_id <> 40")
    row = dws.language_daily(fact, dim).first()
    assert row.total_stars == 42 and row.avg_stars == Decimal("1.05")
    df = spark.createDataFrame([(43, 40), (1, 8), (5, 0)], "a long, b long")
    from repodw.functions.numbers import ratio
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [Decimal("1.08"), Decimal("0.13"), None]


def test_collation_merges_spellings(spark):
    fact = facts(spark, [(1, 1, 5, 0, 0, "OpenEuler", "gitee"), (2, 1, 6, 0, 0, "openeuler", "gitee")])
    assert dws.org_daily(fact).count() == 2
    merged = dws.org_daily(fact, collation="UNICODE_CI_AI")
    assert rows_of(merged, "repo_count", "total_stars") == [(2, 11)]
    dim = projects(spark, [(1, "a", "Go", "gitee"), (2, "b", "GO", "gitee")])
    assert rows_of(dws.language_daily(fact, dim, collation="UNICODE_CI_AI"), "language", "repo_count") == [("GO", 2)]


def test_org_on_two_platforms_is_one_row(spark):
    fact = facts(spark, [(1, 1, 5, 0, 0, "both", "gitee"), (2, 1, 6, 0, 0, "both", "github"), (3, 1, 1, 0, 0, "gone", "x")])
    dim_org = spark.createDataFrame([("both", "github"), ("both", "gitee")], "org_name string, source_platform string")
    rows = rows_of(ads.org_compare(dws.org_daily(fact), dim_org, day(1)), "org_name", "source_platform", "repo_count",
                   "total_stars", "avg_stars", "active_rate")
    assert rows == [("both", "gitee", 2, 11, Decimal("5.50"), Decimal("0.00")),
                    ("gone", "unknown", 1, 1, Decimal("1.00"), Decimal("0.00"))]


def test_org_that_gained_is_active(spark):
    fact = facts(spark, [(1, 1, 5, 0, 0, "o", "gitee"), (1, 2, 5, 0, 0, "o", "gitee"), (2, 2, 6, 0, 0, "o", "gitee")])
    dim_org = spark.createDataFrame([("o", "gitee")], "org_name string, source_platform string")
    assert ads.org_compare(dws.org_daily(fact), dim_org, day(2)).first().active_rate == Decimal("100.00")


def test_ranking_breaks_ties_and_skips_unknown_projects(spark):
    fact = facts(spark, [(p, 2, 50, 1, 0) for p in range(1, 26)] + [(99, 2, 1000, 1, 0), (1, 1, 40, 1, 0)])
    dim = projects(spark, [(p, f"f{p}", "Go", "github") for p in range(1, 26)])
    ranking = ads.project_ranking(dws.project_daily(fact), dim, fact, day(2))
    assert [(r.rank_num, r.full_name, r.star_growth) for r in ranking.orderBy("rank_num").collect()] == [
        (p, f"f{p}", 10 if p == 1 else 0) for p in range(1, 21)]


def test_ranking_keeps_both_orgs_of_a_doubled_project(spark):
    fact = facts(spark, [(1, 1, 9, 0, 0, "a", "gitee"), (1, 1, 8, 0, 0, "b", "github"), (2, 1, 7, 0, 0, "c", "gitee")])
    dim = projects(spark, [(1, "f1", "Go", "gitee"), (2, "f2", "Go", "gitee")])
    ranking = ads.project_ranking(dws.project_daily(fact), dim, fact, day(1), rows=2)
    assert rows_of(ranking, "rank_num", "full_name", "org_name") == [(1, "f1", "a"), (2, "f1", "b")]


def test_share_is_null_on_a_zero_total(spark):
    daily = dws.language_daily(facts(spark, [(1, 1, 0, 0, 0)]), projects(spark, [(1, "f", "Go", "github")]))
    assert ads.language_dist(daily, day(1)).first().pct_of_total is None


def test_shares_add_up_and_platforms_add_to_the_total(spark):
    rng = random.Random(1)
    fact = facts(spark, [(p, 1, rng.randint(0, 500), 0, 0) for p in range(60)])
    dim = projects(spark, [(p, "f", f"L{p % 7}", "gitee" if p % 2 else "github") for p in range(60)])
    total = fact.agg(F.sum("stars_count")).first()[0]
    dist = ads.language_dist(dws.language_daily(fact, dim), day(1)).collect()
    assert abs(sum(r.pct_of_total for r in dist) - 100) <= Decimal("0.07")
    assert dws.platform_daily(fact, dim).agg(F.sum("total_stars")).first()[0] == total


def test_overview_on_a_day_without_facts(spark):
    row = ads.overview(projects(spark, [(1, "f", "Go", "gitee")]), facts(spark, [(1, 1, 5, 5, 5)]), day(9)).first()
    assert tuple(row) == (day(9), 1, 0, 0, 0, 1, 0, Decimal("0.00"))


def test_month_end_is_the_last_day_with_data(spark):
    platform = spark.createDataFrame(
        [("a", date(2024, 1, 5), 10, 1), ("b", date(2024, 1, 5), 20, 1), ("a", date(2024, 1, 9), 7, 2),
         ("a", date(2024, 2, 1), 8, 3)], "source_platform string, snapshot_date date, total_stars long, active_projects long")
    assert rows_of(ads.platform_months(platform), "stat_month", "platform_active", "month_end_stars") == [
        ("2024-01", 4, 7), ("2024-02", 3, 8)]


def test_distinct_repos_count_once_over_days(spark):
    ods = spark.createDataFrame(
        [(1, "a", "2020-01-01T00:00:00Z"), (1, "a", "2020-01-01T00:00:00Z"), (2, "a", ""), (3, "a", None)],
        "repo_id long, source_platform string, created_at string")
    assert rows_of(ads.created_by_month(ods), "stat_month", "new_repos") == [("2020-01", 2)]
    assert rows_of(ads.created_by_month(ods, distinct_repos=True), "stat_month", "new_repos") == [("2020-01", 1)]


def test_empty_tables(spark):
    ods = spark.createDataFrame([], "dt string, x int")
    with pytest.raises(latest.NoRows):
        latest.latest_partition(ods)
    assert latest.latest_snapshot(facts(spark, [])).count() == 0


def test_upsert_and_insert_ignore(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k long, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k long, v string")
    assert rows_of(keyed.upsert(old, new, ["k"]), "k", "v") == sorted([(1, "a"), (2, "B"), (3, "C"), (None, "N")], key=repr)
    assert rows_of(keyed.unseen(old, new, ["k"]), "k", "v") == [(3, "C")]


def test_project_id_on_two_platforms_keeps_the_greater(spark):
    ods = spark.createDataFrame(
        [(7, "n", "a/n", "o", "gitee"), (7, "n", "b/n", "o", "github")],
        "repo_id long, name string, full_name string, org string, source_platform string")
    for column in ("description", "language", "topics", "license_type", "html_url", "created_at"):
        ods = ods.withColumn(column, F.lit(""))
    assert rows_of(dwd.project_rows(ods), "project_id", "source_platform", "full_name") == [(7, "github", "b/n")]
