"""What a load publishes and when, which files it reads and writes, and many days at once."""
import json
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import land, record, rows_of
from test_warehouse import DAYS, contents, day_files, load

from repodw import schemas
from repodw.plans import ads, daily
from repodw.sources.store import Warehouse
from repodw.streaming.ingest import ingest_new_files


def _ids(warehouse):
    return rows_of(warehouse.read("ods_repos_raw"), "dt", "repo_id")


@pytest.mark.parametrize("way", ["stream", "days"])
def test_a_file_keeps_the_day_it_was_given(spark, tmp_path, way):
    """Undated files of several runs: none is lost or repeated when its day is loaded again."""
    landing = tmp_path / "landing"
    landing.mkdir()
    warehouse = Warehouse(spark, str(tmp_path / "w"))

    def run(day, undated_day=None):
        if way == "stream":
            ingest_new_files(spark, str(landing), warehouse, str(tmp_path / "p"), marts=False, undated_day=undated_day)
        else:
            daily.run_days(spark, str(landing), warehouse, [day], undated_day=undated_day)

    (landing / "gitee_repos.json").write_text(json.dumps([record(1, "gitee"), record(2, "gitee")]))
    run("2026-08-06", "2026-08-06")
    land(landing, "github", "2026-08-06", [record(3)])
    run("2026-08-06")
    assert _ids(warehouse) == [("2026-08-06", 1), ("2026-08-06", 2), ("2026-08-06", 3)]
    (landing / "github more+100%.json").write_text(json.dumps([record(4)]))
    run("2026-08-13", "2026-08-13")
    assert _ids(warehouse) == [("2026-08-06", 1), ("2026-08-06", 2), ("2026-08-06", 3), ("2026-08-13", 4)]
    assert rows_of(warehouse.read("landed_files"), "file", "dated", "dt") == [
        ("gitee_repos.json", False, "2026-08-06"), ("github more+100%.json", False, "2026-08-13"),
        ("github_repos_20260806.json", True, "2026-08-06")]


def test_a_day_reads_its_own_files_only(spark, tmp_path):
    for day in DAYS:
        land(tmp_path, "github", day, [record(1)])
    (tmp_path / "github_[x]_20260806.json").write_text(json.dumps([record(2)]))
    from repodw.sources.raw import read_raw_json

    found = read_raw_json(spark, str(tmp_path), files=["github_repos_20260806.json", "github_[x]_20260806.json"])
    assert rows_of(found, "repo_id") == [(1,), (2,)] and len(found.inputFiles()) == 2


class Stopped(RuntimeError):
    pass


def _writes(monkeypatch, stop_at=None, name=None):
    """Counts the writes of a load (folders and lists), and stops it before one of them."""
    done = []
    for method in ("_write", "_write_whole", "_put"):
        def counted(self, path, *more, _own=getattr(Warehouse, method)):
            if len(done) == stop_at or name and path.startswith(name):
                raise Stopped
            done.append(path)
            return _own(self, path, *more)
        monkeypatch.setattr(Warehouse, method, counted)
    return done


def test_a_load_that_stops_anywhere_publishes_nothing(spark, tmp_path, monkeypatch):
    (tmp_path / "raw").mkdir()
    raw, root = str(tmp_path / "raw"), str(tmp_path / "w")
    for n, day in enumerate(DAYS[:2]):
        day_files(tmp_path / "raw", day, n)
    load(spark, raw, root, DAYS[:1])
    before = contents(Warehouse(spark, root))
    for stop in (0, 3, 7, 12, "_state/ods", "_state/root"):
        _writes(monkeypatch, stop if isinstance(stop, int) else None, stop if isinstance(stop, str) else None)
        with pytest.raises(Stopped):
            daily.run_day(spark, raw, Warehouse(spark, root), DAYS[1])
        monkeypatch.undo()
        assert contents(Warehouse(spark, root)) == before, stop
    # A root list cut off in the middle is passed over as well.
    number = Warehouse(spark, root)._next()
    (tmp_path / "w" / "_state" / "root" / f"{number}.json").write_text('{"tab')
    assert Warehouse(spark, root).partitions("fact_repo_stats") == DAYS[:1]
    done = _writes(monkeypatch)
    daily.run_day(spark, raw, Warehouse(spark, root), DAYS[1])
    monkeypatch.undo()
    assert done[-1].startswith("_state/root/") and Warehouse(spark, root).partitions("fact_repo_stats") == DAYS[:2]
    # What broken loads left of the tables this load wrote is gone, and nothing else.
    for table in {path.split("/")[1] for path in done if path.startswith("_state/") and "/root/" not in path}:
        there = {p.name for p in (tmp_path / "w" / table).glob("version=*")}
        lists = [json.loads(p.read_text())["folders"] for p in (tmp_path / "w" / "_state" / table).glob("*.json")]
        assert there == {f.split("/")[1] for found in lists for folders in found.values() for f in folders}, table


def test_many_days_at_once_equal_days_one_by_one(spark, tmp_path):
    """With a late day among them, a project that changes its language, and one only the late day knows."""
    raw = tmp_path / "raw"
    raw.mkdir()
    days = ["2026-08-03", *DAYS]
    for n, day in enumerate(DAYS):
        day_files(raw, day, n)
    land(raw, "github", days[0], [record(3, language="C"), record(77, language="Zig"), record(40, org="early")])
    one, many = (Warehouse(spark, str(tmp_path / name)) for name in ("one", "many"))
    for warehouse in (one, many):
        daily.run_day(spark, str(raw), warehouse, DAYS[0])
    for day in (days[0], DAYS[1], DAYS[2]):
        daily.run_day(spark, str(raw), one, day)
    daily.run_days(spark, str(raw), many)
    expected, found = contents(one), contents(many)
    for table in expected:
        assert found[table] == expected[table], table
    assert [r for r in found["dim_project"] if r[0] == 77] and len(many._versions()) == 2


def test_only_buckets_with_changes_are_written(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    land(raw, "github", DAYS[0], [record(k) for k in range(200)])
    land(raw, "github", DAYS[1], [record(k, stars_count=9) for k in range(200)])
    land(raw, "github", DAYS[2], [record(k, language="Rust" if k == 5 else "Go") for k in range(200)])
    warehouse = load(spark, str(raw), tmp_path / "w", DAYS[:1])
    first = dict(warehouse._list("dim_project"))
    assert len(first) == schemas.BUCKETS
    daily.run_day(spark, str(raw), warehouse, DAYS[1])
    assert warehouse._list("dim_project") == first
    facts = dict(warehouse._list("fact_repo_stats"))
    daily.run_day(spark, str(raw), warehouse, DAYS[2])
    mine = str(spark.range(5, 6).select(warehouse.bucket_of(F.col("id"))).first()[0])
    assert {b for b, f in warehouse._list("dim_project").items() if f != first[b]} == {mine}
    assert {d for d, f in warehouse._list("fact_repo_stats").items() if facts.get(d) != f} == {DAYS[2]}
    assert rows_of(warehouse.read("dim_project").filter("language = 'Rust'"), "project_id") == [(5,)]
    # The facts of the project that moved are looked up in its bucket alone, on all days.
    moved = daily.moved_facts(warehouse, spark.range(5, 6).withColumnRenamed("id", "project_id"), [DAYS[2]])
    plan = moved._jdf.queryExecution().toString()
    assert re.search(rf"PartitionFilters: \[[^\]]*bucket#\d+ = {mine}\b", plan)
    assert moved.filter("project_id = 5").count() == 2 and moved.count() < 200
    assert rows_of(warehouse.read("dws_language_daily"), "language", "snapshot_date", "repo_count") == sorted(
        [(lang, date.fromisoformat(d), n) for d in DAYS for lang, n in (("Go", 199), ("Rust", 1))], key=repr)


def test_month_state_follows_reruns(spark, tmp_path, monkeypatch):
    """A rerun takes a project's best total of the month away; only then are other days of the month read."""
    raw = tmp_path / "raw"
    raw.mkdir()
    for n, day in enumerate(DAYS):
        land(raw, "github", day, [record(1, stars_count=10 + n), record(2, stars_count=50 - 10 * n), record(3, stars_count=5)])
    warehouse = load(spark, str(raw), tmp_path / "w", DAYS)
    best = lambda: {r["project_id"]: (r["days"], r["gained"], r["best"]) for r in warehouse.read("dws_project_month").collect()}
    assert best() == {1: (3, 2, 12), 2: (3, -20, 50), 3: (3, 0, 5)}
    read, own = [], Warehouse.read_days
    monkeypatch.setattr(Warehouse, "read_days", lambda self, table, days: read.append((table, *sorted(days))) or own(self, table, days))
    daily.run_day(spark, str(raw), warehouse, DAYS[2])
    rollups = {d for t, *days in read if t == "dws_project_daily" for d in days}
    assert rollups == {DAYS[2], "2026-08-08"} and best() == {1: (3, 2, 12), 2: (3, -20, 50), 3: (3, 0, 5)}
    land(raw, "github", DAYS[0], [record(1, stars_count=10), record(2, stars_count=20)])
    daily.run_day(spark, str(raw), warehouse, DAYS[0])
    assert best() == {1: (3, 2, 12), 2: (3, 10, 40), 3: (2, 0, 5)}
    kept = contents(warehouse)
    daily.rebuild_rollups(warehouse)
    daily.rebuild_months(warehouse)
    assert contents(warehouse) == kept
    rows = ads.monthly(warehouse.read("dws_project_daily"), warehouse.read("dws_org_daily"), warehouse.read("dws_platform_daily"))
    assert rows_of(rows, *sorted(rows.columns)) == rows_of(warehouse.read("dws_monthly"), *sorted(rows.columns))


def test_names_that_differ_in_case_and_accents_are_one(spark, tmp_path):
    """Under a collation: one organisation by the spelling that came first, one platform, one language."""
    raw = tmp_path / "raw"
    raw.mkdir()
    land(raw, "github", DAYS[0], [record(1, "Gitee", org="Café", language="go"), record(2, "gitee", org="café"), record(3, org="Other")])
    land(raw, "github", DAYS[1], [record(1, "GITEE", org="CAFE", language="Go"), record(2, "gitee", org="cafe"), record(3, "GitHub", org="OTHER"),
                                  record(4, org="ÖTHER", language="GO")])
    days = {"one": None, "many": None}
    for name in days:
        warehouse = Warehouse(spark, str(tmp_path / name), collation="UNICODE_CI_AI")
        if name == "one":
            for day in DAYS[:2]:
                daily.run_day(spark, str(raw), warehouse, day)
        else:
            daily.run_days(spark, str(raw), warehouse)
        days[name] = contents(warehouse)
    warehouse = Warehouse(spark, str(tmp_path / "one"))  # the warehouse remembers its collation
    assert warehouse.collation == "UNICODE_CI_AI" and days["one"] == days["many"]
    orgs = rows_of(warehouse.read("dim_org"), "org_name", "source_platform")
    first = {o for o, _ in orgs if o.lower().startswith("c")}
    assert len(first) == 1 and len(orgs) == 2 and {p for _, p in orgs} == {"gitee", "github"}
    assert rows_of(warehouse.latest("ads_org_compare"), "org_name", "source_platform", "repo_count") == [
        (*first, "gitee", 2), ("Other", "github", 2)][::1 if min(first) < "Other" else -1]
    overview = warehouse.latest("ads_overview").first()
    assert (overview["total_orgs"], overview["gitee_repos"], overview["github_repos"]) == (2, 2, 2)
    assert rows_of(warehouse.latest("dws_language_daily"), "repo_count") == [(4,)]
    assert rows_of(warehouse.latest("dws_platform_daily"), "source_platform", "repo_count") == [("gitee", 2), ("github", 2)]
    plain = Warehouse(spark, str(tmp_path / "plain"))
    daily.run_days(spark, str(raw), plain)
    assert plain.latest("ads_overview").first()["total_orgs"] == 4


def test_scratch_is_shared_or_refused_and_cleared(spark):
    from repodw.session import scratch_for, scratch_scope, written

    assert scratch_for("s3a://b/x/", "file:/w", "yarn") == "s3a://b/x"
    assert scratch_for(None, "hdfs://n/w/", "spark://h:1") == "hdfs://n/w/_scratch" and scratch_for(None, "file:/w", "local[4]") == "file:/w/_scratch"
    for local in ("file:/w", "/w"):
        with pytest.raises(ValueError):
            scratch_for(None, local, "spark://h:1")
    with scratch_scope(spark):
        inside = written(spark.range(3), "scoped")
        folder = inside.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").replace("//", "/")
        assert inside.count() == 3
    import os

    assert not os.path.exists(folder)
