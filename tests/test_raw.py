import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import land, record, rows_of

from repodw import schemas
from repodw.operators.dedup import keep_one
from repodw.sources import payload, raw, selection


def test_junk_files_are_skipped(spark, tmp_path):
    land(tmp_path, "gitee", "2026-08-07", [record(1, "gitee"), record(2, "gitee")])
    land(tmp_path, "github", "2026-08-07", [record(1)], indent=None)
    land(tmp_path, "gitee", "2026-08-06", [])
    (tmp_path / "github_nine.json").write_text('[{"a":1}]')
    (tmp_path / "gitee_checkpoint.json").write_text(
        json.dumps({"completed_orgs": [], "collected_repos": [record(9)]}, indent=2))
    (tmp_path / "github_progress.json").write_text('{"completed_orgs":[]}')
    (tmp_path / "gitlab_repos.json").write_text(json.dumps([record(8)]))
    (tmp_path / "github_notes.txt").write_text(json.dumps([record(7)]))
    (tmp_path / "github_object.json").write_text(json.dumps({"a": {"x": 1}, "b": {"y": 2}}, indent=2))
    found = raw.read_raw_json(spark, str(tmp_path))
    assert rows_of(found, "repo_id", "source_platform") == [(1, "gitee"), (1, "github"), (2, "gitee")]


@pytest.mark.parametrize("indent", [None, 0, 1, 2, 4])
def test_any_layout_gives_the_same_records(spark, tmp_path, indent):
    tricky = 'quote " brace\n  }, {\n  } end'
    land(tmp_path, "github", "2026-08-07",
         [record(i, description=tricky, topics=["a", "b"]) for i in range(5)], indent=indent)
    found = raw.read_raw_json(spark, str(tmp_path))
    assert rows_of(found, "repo_id", "description", "topics") == [(i, tricky, '["a","b"]') for i in range(5)]


def test_large_indented_file_is_split_and_keeps_its_order(spark, tmp_path):
    land(tmp_path, "github", "2026-08-07", [record(i % 100, stars_count=i) for i in range(2000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        found = raw.read_raw_json(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() > 4
        assert found.count() == 2000
        first = keep_one(found, ["repo_id", "source_platform"], raw.raw_order())
        last = keep_one(found, ["repo_id", "source_platform"], raw.raw_order(), keep="last")
        assert rows_of(first, "repo_id", "stars_count") == sorted([(i, i) for i in range(100)], key=repr)
        assert rows_of(last, "repo_id", "stars_count") == sorted([(i, 1900 + i) for i in range(100)], key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_broken_json_is_an_error(spark, tmp_path):
    (tmp_path / "github_repos_20260807.json").write_text('[{"repo_id": 1, "name": }]')
    with pytest.raises(PySparkException):
        raw.read_raw_json(spark, str(tmp_path)).collect()


def test_no_usable_file_gives_no_rows(spark, tmp_path):
    land(tmp_path, "github", "2026-08-07", [])
    found = raw.read_raw_json(spark, str(tmp_path))
    assert found.count() == 0
    assert set(schemas.RAW.fieldNames()) <= set(found.columns)


def test_only_files_of_the_day(spark, tmp_path):
    land(tmp_path, "github", "2026-08-06", [record(1)])
    land(tmp_path, "github", "2026-08-07", [record(2)])
    assert rows_of(raw.read_raw_json(spark, str(tmp_path), day="2026-08-07"), "repo_id") == [(2,)]


def _normalize(spark, platform, body, org=None):
    df = spark.createDataFrame([(json.dumps(body), "asked")], "payload string, asked string")
    return payload.normalize_payload(df, platform, org="asked" if org else None).first()


def test_defaults_stand_in_for_missing_keys_only(spark):
    row = _normalize(spark, "github", {"id": 5, "stargazers_count": None, "name": None}, org=True)
    assert (row.repo_id, row.org, row.stars_count, row.forks_count, row.name, row.full_name) == (5, "asked", None, 0, None, "")
    row = _normalize(spark, "github", {"id": 5, "description": None, "language": None, "homepage": None, "archived": None})
    assert (row.description, row.language, row.homepage, row.archived) == ("", "", None, None)


def test_license_topics_and_owner(spark):
    body = {"id": 1, "license": {"spdx_id": "MIT"}, "topics": ["a", "b"], "owner": {"login": "me"},
            "namespace": {"path": "us"}, "archived": True, "homepage": "h"}
    row = _normalize(spark, "github", body)
    assert (row.license_type, row.topics, row.org, row.archived, row.homepage) == ("MIT", "a, b", "me", True, "h")
    row = _normalize(spark, "gitee", body)
    assert (row.license_type, row.topics, row.org, row.archived, row.homepage) == ("", "", "us", False, "")
    row = _normalize(spark, "github", {"id": 1, "license": None, "topics": [], "owner": None})
    assert (row.license_type, row.topics, row.org) == ("", "", "")
    with pytest.raises(ValueError):
        _normalize(spark, "other", {"id": 1})


def test_responses_are_lists_or_objects_with_items(spark):
    hits = [{"id": 1, "namespace": {"path": "a"}}, {"id": 2, "name": 'quo"te'}]
    df = spark.createDataFrame(
        [("x", json.dumps(hits)), ("y", json.dumps({"total": 2, "items": hits})), ("z", "[]"), ("w", '{"message": "no"}')],
        "asked string, response string")
    items = payload.response_items(df)
    assert rows_of(items.groupBy("asked").count(), "asked", "count") == [("x", 2), ("y", 2)]
    rows = payload.normalize_payload(items, "gitee")
    assert rows_of(rows.distinct(), "repo_id", "org", "name") == [(1, "a", ""), (2, "", 'quo"te')]


def test_keyword_pick_keeps_the_best_per_keyword(spark):
    df = spark.range(50).select(F.col("id").alias("repo_id"), F.lit("n").alias("name"),
                                F.concat(F.lit("openEuler/"), "id").alias("full_name"),
                                F.lit(None).cast("string").alias("description"),
                                (F.col("id") % 10).alias("stars_count"))
    picked = selection.keyword_pick(df, ["OPENEULER", "euler/4", "none"], rows=3)
    assert rows_of(picked, "keyword", "repo_id") == [
        ("OPENEULER", 19), ("OPENEULER", 29), ("OPENEULER", 9), ("euler/4", 47), ("euler/4", 48), ("euler/4", 49)]


def test_raw_arrays_round_trip(spark, tmp_path):
    rows = [record(i, "gitee" if i % 2 else "github", description=f'x"\n  }}{i}') for i in range(100)]
    df = spark.createDataFrame([tuple(r[f] if f in r else None for f in schemas.RAW.fieldNames()) for r in rows], schemas.RAW)
    raw.write_raw_arrays(df, str(tmp_path / "out"), "2026-08-07", records_per_file=30)
    for path in (tmp_path / "out").rglob("part-*"):
        assert isinstance(json.loads(path.read_text()), list)
    back = raw.read_raw_json(spark, str(tmp_path / "out"), names="part-*").select(*df.columns)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_subfolders_and_days_of_files(spark, tmp_path):
    """A folder that repeats the landing folder's name, a path with two dates, a file without any."""
    landing = tmp_path / "raw"
    (landing / "gitee_raw").mkdir(parents=True)
    (landing / "batch_20260806").mkdir()
    land(landing / "gitee_raw", "x", "2026-08-07", [record(1, "gitee"), record(2, "gitee")])
    land(landing / "batch_20260806", "github", "2026-08-07", [record(3)])
    (landing / "gitee_repos.json").write_text(json.dumps([record(4, "gitee")]))
    read = lambda **how: [r[0] for r in rows_of(raw.read_raw_json(spark, str(landing), **how), "repo_id")]
    assert read() == [1, 2, 3, 4]
    assert read(day="2026-08-07") == [1, 2, 3] and read(day="2026-08-06") == []
    assert read(day="2026-08-06", undated=True) == [4]
    assert raw.undated_files(spark, str(landing)) == ["gitee_repos.json"]


def test_values_of_other_types_are_cast_or_refused(spark, tmp_path):
    odd = [record(1, stars_count=5.0, archived=1), record(2, stars_count="12", archived="1"), record(3, archived="false")]
    for r in odd[:2]:
        r.pop("source_platform")
    land(tmp_path, "gitee", "2026-08-07", odd)
    found = raw.read_raw_json(spark, str(tmp_path))
    assert rows_of(found, "repo_id", "stars_count", "archived", "source_platform") == [
        (1, 5, True, "unknown"), (2, 12, True, "unknown"), (3, 1, False, "github")]
    for n, bad in enumerate([{"stars_count": 3000000000}, {"stars_count": "many"}, {"stars_count": 1.5}, {"archived": "perhaps"}]):
        (tmp_path / f"bad{n}").mkdir()
        land(tmp_path / f"bad{n}", "github", "2026-08-07", [record(1, **bad)])
        with pytest.raises(PySparkException):
            raw.read_raw_json(spark, str(tmp_path / f"bad{n}")).collect()


def test_keyword_pick_of_null_and_repeated_ids(spark):
    rows = [(None, "n", f"openEuler/{k}", None, 100 + k) for k in range(4)] + [(7, "n", "openEuler/x", None, 90)] * 3 + [(7, "n", "other", None, 500)]
    df = spark.createDataFrame(rows, "repo_id long, name string, full_name string, description string, stars_count int")
    picked = selection.keyword_pick(df, ["euler"], rows=6)
    assert picked.columns == [*df.columns, "keyword"]
    assert rows_of(picked, "full_name", "stars_count") == [(f"openEuler/{k}", 100 + k) for k in range(4)] + [("openEuler/x", 90)] * 2
