import json
from datetime import date

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import land, record, rows_of

from repodw import schemas
from repodw.plans import daily, serve
from repodw.sources.store import Warehouse
from repodw.streaming.ingest import ingest_new_files

DAYS = ["2026-08-05", "2026-08-06", "2026-08-07"]


def day_files(folder, day, n):
    """Stars grow by the day; project 3 changes its language on the last day; project 40+n is new each day."""
    language = {3: "Rust" if n == 2 else "Go"}
    github = [record(i, "github", org=f"org{i % 3}", stars_count=10 * i + n * i, language=language.get(i, "Go"),
                     open_issues_count=i % 2, created_at=f"2020-0{1 + i % 9}-02T03:04:05Z") for i in range(1, 30)]
    github += [record(40 + n, "github", org="org0", language="C"), record(5, "github", archived=True, name="later copy")]
    gitee = [record(100 + i, "gitee", org="org1", stars_count=i, language="") for i in range(5)]
    gitee += [record(200, "gitee", description="已迁移")]
    land(folder, "github", day, github)
    land(folder, "gitee", day, gitee)


@pytest.fixture()
def raw_dir(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for n, day in enumerate(DAYS):
        day_files(folder, day, n)
    return str(folder)


def contents(warehouse):
    out = {}
    for table in schemas.TABLES:
        if table not in ("sys_log", "dim_date"):
            df = warehouse.read(table)
            if "etl_time" in df.columns:
                assert df.filter("etl_time IS NULL").isEmpty()
                df = df.drop("etl_time")
            out[table] = rows_of(df, *df.columns)
    return out


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """All days loaded in order: the landing folder, the warehouse, and what its tables hold."""
    folder = tmp_path_factory.mktemp("whole")
    (folder / "raw").mkdir()
    for n, day in enumerate(DAYS):
        day_files(folder / "raw", day, n)
    warehouse = load(spark, str(folder / "raw"), folder / "wh", DAYS)
    return str(folder / "raw"), warehouse, contents(warehouse)


def load(spark, raw_dir, root, days):
    warehouse = Warehouse(spark, str(root))
    for day in days:
        daily.run_day(spark, raw_dir, warehouse, day)
    return warehouse


def test_days_reruns_late_days_and_rebuild_agree(spark, whole, tmp_path):
    raw_dir, warehouse, first = whole
    for table, keys in schemas.KEYS.items():
        rows = warehouse.read(table)
        assert rows.count() == rows.select(*keys).distinct().count(), table
    assert len(first["ods_repos_raw"]) == 3 * 35
    assert len(first["dim_project"]) == 37
    assert len(first["ads_project_ranking"]) == 3 * 20

    # Project 3 is counted under its new language on all days.
    languages = warehouse.read("dws_language_daily").filter("language = 'Rust'")
    assert rows_of(languages, "snapshot_date", "repo_count", "total_stars") == [
        (date(2026, 8, 5), 1, 30), (date(2026, 8, 6), 1, 33), (date(2026, 8, 7), 1, 36)]
    ranking = serve.q_ranking(warehouse.read("ads_project_ranking")).collect()
    assert (ranking[0].fullName, ranking[0].starsCount, ranking[0].starGrowth) == ("org1/r29", 348, 29)

    # The same day again changes nothing.
    daily.run_day(spark, raw_dir, warehouse, DAYS[2])
    assert contents(warehouse) == first

    # All rollups from scratch equal the day by day ones.
    daily.rebuild_rollups(warehouse)
    assert len(warehouse._versions()) == 2
    daily.rebuild_months(warehouse)
    assert contents(warehouse) == first

    # A day that comes late repairs the changes of the day after it.
    late = contents(load(spark, raw_dir, tmp_path / "b", [DAYS[0], DAYS[2], DAYS[1]]))
    for table in ("ods_repos_raw", "fact_repo_stats", "dws_project_daily", "dws_org_daily", "dws_language_daily",
                  "dws_platform_daily", "dim_project", "dim_org", "ads_overview", "ads_language_dist"):
        if table.startswith("ads_"):  # marts are of the newest day only, so a late day gets none
            assert not [r for r in late[table] if date(2026, 8, 6) in r], table
            others = [[r for r in side[table] if date(2026, 8, 6) not in r] for side in (first, late)]
            assert others[0] and others[0] == others[1], table
        else:
            assert late[table] == first[table], table


def test_emptied_day_is_removed(spark, raw_dir, tmp_path):
    warehouse = load(spark, raw_dir, tmp_path / "w", DAYS[:2])
    ods = warehouse.read("ods_repos_raw").filter(F.lit(False))
    warehouse.replace_days("ods_repos_raw", ods, [DAYS[1]])
    assert rows_of(warehouse.read("ods_repos_raw").select("dt").distinct(), "dt") == [(DAYS[0],)]
    assert warehouse.newest_partition("ods_repos_raw") == DAYS[0]


def test_broken_run_leaves_the_dimension_and_can_be_repeated(spark, whole, tmp_path, monkeypatch):
    raw_dir, _, complete = whole
    warehouse = load(spark, raw_dir, tmp_path / "broken", DAYS[:2])
    before = contents(warehouse)["dim_project"]
    for step in ("refresh_rollups", "_write_attribute_rollups", "refresh_months"):
        monkeypatch.setattr(daily, step, lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            daily.run_day(spark, raw_dir, warehouse, DAYS[2])
        assert (contents(warehouse)["dim_project"] == before) == (step != "refresh_months")
        monkeypatch.undo()
    daily.run_day(spark, raw_dir, warehouse, DAYS[2])
    assert contents(warehouse) == complete


def test_partition_values_keep_their_types(spark, raw_dir, tmp_path):
    warehouse = load(spark, raw_dir, tmp_path / "w", DAYS[:1])
    for table, schema in schemas.TABLES.items():
        assert warehouse.read(table).schema == schema, table
    with pytest.raises(ValueError):
        daily.refresh_day(Warehouse(spark, str(tmp_path / "none")), DAYS[0])
    daily.refresh_marts(Warehouse(spark, str(tmp_path / "none")))
    assert not (tmp_path / "none").exists()


def test_files_are_sorted_by_their_key(spark, raw_dir, tmp_path):
    import pyarrow.parquet as pq

    load(spark, raw_dir, tmp_path / "w", DAYS[:2])
    for table in ("fact_repo_stats", "dws_project_daily"):
        files = list((tmp_path / "w" / table).rglob("*.parquet"))
        assert files
        for file in files:
            ids = pq.ParquetFile(file).read(["project_id"])["project_id"].to_pylist()
            assert ids == sorted(ids)


def test_old_files_without_platform(spark, tmp_path):
    folder = tmp_path / "old"
    folder.mkdir()
    land(folder, "gitee", DAYS[0], [{"repo_id": 1, "full_name": "a/b", "description": "x", "language": "Go",
                                     "license": "MIT", "stars_count": 3, "created_at": ""}])
    old = schemas.raw_without("source_platform", "license_type", "topics", "archived", "homepage")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    daily.run_day(spark, str(folder), warehouse, DAYS[0], old)
    row = warehouse.read("ods_repos_raw").first()
    assert (row.source_platform, row.license_type, row.archived, row.forks_count) == ("unknown", "MIT", 0, None)


def test_stream_takes_each_file_once_and_equals_the_batch(spark, whole, tmp_path):
    growing = tmp_path / "growing"
    growing.mkdir()
    warehouse, progress = Warehouse(spark, str(tmp_path / "stream")), str(tmp_path / "progress")
    for n, day in enumerate(DAYS):
        day_files(growing, day, n)
        query = ingest_new_files(spark, str(growing), warehouse, progress)
        assert sum(p["numInputRows"] for p in query.recentProgress) == 2
    assert contents(warehouse) == whole[2]
    query = ingest_new_files(spark, str(growing), warehouse, progress)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 0


def test_command_line(spark, raw_dir, tmp_path, capsys):
    from repodw.__main__ import main

    root = str(tmp_path / "w")
    main(["run-day", "--raw", raw_dir, "--warehouse", root, "--day", DAYS[0]])
    main(["query", "ranking", "--warehouse", root])
    main(["query", "repos", "--warehouse", root, "--keyword", "r29", "--size", "10"])
    main(["query", "org-repos", "--warehouse", root, "--org", "org2"])
    for more in (["filter", "--platform", "github", "--chart", "pie"], ["compare", "--names", "org1/r28", "org2/r29"], ["languages"],
                 ["top-languages"], ["top-orgs"], ["audit", "--action", "login"]):
        main(["query", *more, "--warehouse", root])
    main(["profile", "--raw", raw_dir])
    out = capsys.readouterr().out
    assert "org1/r29" in out and "original" in out
    main(["export", "--warehouse", root, "--out", str(tmp_path / "csv"), "--single-file"])
    assert len(list((tmp_path / "csv").glob("part-*"))) == 1
    main(["calendar", "--warehouse", root, "--start", "2026-01-01", "--end", "2026-12-31"])
    main(["calendar", "--warehouse", root])
    assert Warehouse(spark, root).read("dim_date").count() == 365
    before = contents(Warehouse(spark, root))
    main(["rebuild", "--warehouse", root])
    assert contents(Warehouse(spark, root)) == before


def test_marts_and_months_of_an_emptied_day_go(spark, raw_dir, tmp_path):
    warehouse = load(spark, raw_dir, tmp_path / "w", DAYS[:2])
    assert warehouse.newest_partition("ads_overview") == DAYS[1]
    empty = spark.read.schema(schemas.RAW).json(spark.sparkContext.emptyRDD()).withColumns(
        {"file_name": F.lit(""), "file_block": F.lit(0), "pos": F.lit(0)})
    daily.load_ods(warehouse, empty, DAYS[1])
    daily.refresh_day(warehouse, DAYS[1])
    for table in daily.DAY_MARTS:
        assert warehouse.newest_partition(table) == DAYS[0], table
    # What no fact or raw row stands for any more is gone after a rebuild.
    created = warehouse.read("dws_created_monthly").withColumn("dt", F.lit("2020-01-01"))
    warehouse.replace_days("dws_created_monthly", created)
    daily.rebuild_months(warehouse)
    assert warehouse.partitions("dws_created_monthly") == [DAYS[0]]


def test_undated_files_are_refused_or_loaded(spark, raw_dir, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    land(landing, "github", DAYS[0], [record(1)])
    (landing / "gitee_repos.json").write_text(json.dumps([record(2, "gitee")]))
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    with pytest.raises(ValueError):
        daily.run_day(spark, str(landing), warehouse, DAYS[0])
    daily.run_day(spark, str(landing), warehouse, DAYS[0], undated=True)
    assert warehouse.read("fact_repo_stats").count() == 2
    streamed = Warehouse(spark, str(tmp_path / "s"))
    with pytest.raises(StreamingQueryException):
        ingest_new_files(spark, str(landing), streamed, str(tmp_path / "p"), marts=False)
    ingest_new_files(spark, str(landing), streamed, str(tmp_path / "p"), marts=False, undated_day=DAYS[0])
    assert streamed.read("ods_repos_raw").count() == 2
