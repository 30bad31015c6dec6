from pyspark.sql import functions as F

from helpers import record, rows_of

from repodw import schemas
from repodw.functions import text
from repodw.plans import clean


def frame(spark, *records):
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.RAW.fields) + ", seq int"
    fields = schemas.RAW.fieldNames()
    return spark.createDataFrame([tuple(r.get(f) for f in fields) + (i,) for i, r in enumerate(records)], schema)


def test_equal_ids_on_two_platforms_both_stay(spark):
    df = frame(spark, record(7, "gitee"), record(7, "github"), record(7, "gitee", name="later"))
    assert rows_of(clean.clean_repos(df, ["seq"]), "repo_id", "source_platform", "name") == [
        (7, "gitee", "r7"), (7, "github", "r7")]


def test_null_keys_equal_each_other(spark):
    df = frame(spark, record(None, None), record(None, None), record(None, "gitee"))
    assert clean.clean_repos(df, ["seq"]).count() == 2


def test_migrated_counts_on_gitee_and_unknown_only(spark):
    df = frame(spark, *[record(i, p, description="已迁移") for i, p in enumerate(["gitee", "unknown", "github", None])],
               record(9, "gitee", description="has been MIGRATED away"))
    assert rows_of(clean.clean_repos(df, ["seq"]), "repo_id") == [(2,), (3,)]


def test_archived_counts_on_github_only(spark):
    df = frame(spark, *[record(i, p, archived=True) for i, p in enumerate(["gitee", "unknown", "github", None])],
               record(9, "github", archived=None))
    assert rows_of(clean.clean_repos(df, ["seq"]), "repo_id") == [(0,), (1,), (3,), (9,)]


def test_dropped_first_row_does_not_bring_back_a_duplicate(spark):
    df = frame(spark, record(1, archived=True), record(1, archived=False))
    assert clean.clean_repos(df, ["seq"]).count() == 0


def test_blank_descriptions_and_languages(spark):
    df = frame(spark, record(1, description=None, language=None), record(2, description="", language=""),
               record(3, description=" ", language=" "))
    assert rows_of(clean.clean_repos(df, ["seq"]), "repo_id", "description", "language") == [
        (1, "无", "未标注"), (2, "无", "未标注"), (3, " ", " ")]


def test_spam_limit_counts_characters(spark):
    df = frame(spark, record(1, description="信" * 15000), record(2, description="信" * 15001))
    assert rows_of(clean.clean_repos(df, ["seq"]), "repo_id") == [(1,)]


def test_long_names_are_cut(spark):
    row = clean.clean_repos(frame(spark, record(1, full_name="n" * 300, html_url="u" * 251)), ["seq"]).first()
    assert (len(row.full_name), len(row.html_url)) == (250, 250)


def test_topics(spark):
    df = spark.createDataFrame([(1, '["a","b"]'), (2, "a, b"), (3, "[]"), (4, None), (5, "")], "id int, topics string")
    col = text.topics_to_text(F.col("topics"))
    assert rows_of(df.select("id", col.alias("t")), "id", "t") == [(1, "a, b"), (2, "a, b"), (3, ""), (4, ""), (5, "")]
    strict = text.topics_to_text(F.col("topics"), strict=True)
    assert rows_of(df.select("id", strict.alias("t")), "id", "t") == [(1, "a, b"), (2, ""), (3, ""), (4, ""), (5, "")]


def test_created_at_month_time_and_utc_year(spark):
    df = spark.createDataFrame([("2020-12-31T20:00:00-08:00",), ("",), ("x",), (None,)], "c string")
    rows = df.select(text.month_of_text(F.col("c")).alias("m"), text.parse_created_at(F.col("c")).cast("string").alias("t"),
                     text.utc_year(F.col("c")).alias("y")).collect()
    assert [tuple(r) for r in rows] == [("2020-12", "2020-12-31 20:00:00", 2021), ("", None, None), ("x", None, None),
                                        (None, None, None)]


def test_utc_year_of_written_forms(spark):
    forms = {"2020-12-31T23:30:00-01:00": 2021, "2020-12-31T23:30:00Z": 2020, "2020-12-31 23:30:00": 2020, "2020-12-31": 2020,
             "2021-01-01T00:30:00+0800": 2020, "12:30": None, "2020-13-01": None, "": None}
    df = spark.createDataFrame([(c,) for c in forms], "c string")
    for zone in ("UTC", "Asia/Shanghai", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = {r.c: r.y for r in df.select("c", text.utc_year(F.col("c")).alias("y")).collect()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == forms, zone


def test_ods_row_defaults(spark):
    df = spark.createDataFrame(
        [(1, "", "Apache", "1"), (2, "MIT", "Apache", "true"), (3, None, "BSD", "0"), (4, "", None, None)],
        "repo_id long, license_type string, license string, archived string")
    out = clean.normalize_ods(df, "2026-08-07")
    assert rows_of(out, "repo_id", "license_type", "archived", "source_platform", "stars_count", "dt", "language") == [
        (1, "Apache", 1, "unknown", 0, "2026-08-07", "未标注"), (2, "MIT", 1, "unknown", 0, "2026-08-07", "未标注"),
        (3, "BSD", 0, "unknown", 0, "2026-08-07", "未标注"), (4, None, 0, "unknown", 0, "2026-08-07", "未标注")]


def test_missing_column_gets_a_default_but_nulls_stay(spark):
    df = spark.createDataFrame([(1, None)], "repo_id long, source_platform string")
    row = clean.fill_missing_columns(df).first()
    assert (row.source_platform, row.topics, row.archived) == (None, "", False)
    row = clean.fill_missing_columns(df.drop("source_platform")).first()
    assert row.source_platform == "unknown"


def test_audit_follows_the_rule_order(spark):
    df = frame(
        spark, record(1, "gitee", description="已迁移"), record(1, "gitee"), record(2, "github", archived=True),
        record(3, "github", description="x" * 15001, language=None), record(4, "gitee", language=""),
        record(5, "github", description=None, language=None), record(6, None, language=None))
    row = clean.clean_audit(df, ["seq"]).first().asDict()
    assert row == {"original": 7, "duplicates": 1, "unique_rows": 6, "empty_descriptions": 1, "migrated": 1, "archived": 1,
                   "invalid": 2, "spam": 1, "no_language_gitee": 1, "no_language_github": 1, "kept": 3}
