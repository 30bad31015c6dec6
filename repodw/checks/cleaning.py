"""Sources and cleaning over documents, line items and the calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from repodw import fixed_values as V
from repodw.checks.bindings import Documents, Events, Lines
from repodw.checks.registry import query
from repodw.functions import text
from repodw.operators import dedup
from repodw.plans import clean
from repodw.session import scratch_dir
from repodw.sources import calendar, payload, raw, selection, store
from repodw.streaming.ingest import ingest_new_files

O = Documents.SQL
PATTERN = "license|copyright"
DAY = "2026-08-07"
COLUMNS = "repo_id, org, full_name, description, language, source_platform, archived, stars_count"
_FIELDS = COLUMNS.split(", ")
_ON_GITEE = "coalesce(source_platform IN ('gitee', 'unknown'), FALSE)"
_MIGRATED = f"({_ON_GITEE} AND regexp_matches(coalesce(description, ''), '(?i){PATTERN}'))"
_ARCHIVED = "(coalesce(source_platform = 'github', FALSE) AND archived)"
_BLANK = "(description IS NULL OR description = '')"
_DESCRIPTION = f"CASE WHEN {_BLANK} THEN '{V.NO_DESCRIPTION}' ELSE description END"
_LANGUAGE = f"CASE WHEN language IS NULL OR language = '' THEN '{V.NO_LANGUAGE}' ELSE language END"
_SPAM = f"coalesce(length(description), 0) > {V.DESCRIPTION_MAX}"


def _collected_from():
    return F.when(F.col("repo_id") % 2 == 0, "gitee").otherwise("github")


def _landed(o: Documents):
    """The records written as array files, read back as raw files."""
    folder = scratch_dir(o.spark, "raw")
    raw.write_raw_arrays(o.raw, folder, DAY, _collected_from(), records_per_file=500)
    return raw.read_raw_json(o.spark, folder, names="part-*")


@query("read_raw_json", Documents, O + f"SELECT {COLUMNS} FROM fx_raw")
def _(o):
    return _landed(o).select(*_FIELDS)


@query("skip_bad_raw_files", Documents, O + """
SELECT CASE WHEN repo_id % 2 = 0 THEN 'gitee' ELSE 'github' END || '_repos_20260807' AS files, count(*) AS records,
       CAST(sum(stars_count) AS BIGINT) AS stars
FROM fx_raw WHERE repo_id % 3 <> 0 GROUP BY 1""")
def _(o):
    """Every third record is landed in a file that is no list of records, and so is left out."""
    folder = scratch_dir(o.spark, "raw")
    raw.write_raw_arrays(o.raw.filter("repo_id % 3 <> 0"), folder, DAY, _collected_from())
    objects = o.raw.filter("repo_id % 3 = 0").select(
        F.to_json(F.struct(F.array(F.struct("repo_id")).alias("collected_repos"))).alias("value")
    )
    objects.write.text(f"{folder}/files=gitee_progress")
    o.raw.limit(1).select(F.lit("[]").alias("value")).write.text(f"{folder}/files=github_empty")
    records = raw.read_raw_json(o.spark, folder, names="part-*")
    files = F.regexp_extract("file_name", "files=([a-z]+_repos_[0-9]+)", 1).alias("files")
    return records.groupBy(files).agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.col("stars_count").cast("long")).alias("stars")
    )


@query("union_platforms", Documents, O + """
SELECT repo_id, full_name, language, archived FROM fx_raw WHERE source_platform = 'github'
UNION ALL
SELECT repo_id, full_name, language, NULL AS archived FROM fx_raw WHERE source_platform IS DISTINCT FROM 'github'""")
def _(o):
    github = o.raw.filter("source_platform = 'github'").select("repo_id", "full_name", "language", "archived")
    others = o.raw.filter("NOT source_platform <=> 'github'").select("language", "full_name", "repo_id")
    return raw.union_platforms([github, others])


_PAYLOAD_SQL = """,
fx_api AS (
  SELECT doc_id, source, lang, n_chars, source || '/' || doc_id AS full_name,
         CASE WHEN doc_id % 7 = 0 THEN 0 ELSE n_chars END AS stars,
         CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'from ' || lang END AS description,
         CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang || ', t' || doc_id % 10 END AS topics,
         CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'MIT' END AS license_type
  FROM documents)"""


def _payloads(o: Documents, with_owner: bool):
    doc = F.col("doc_id")
    fields = [
        doc.alias("id"), F.concat("source", F.lit("/"), doc).alias("full_name"), F.col("source").alias("name"),
        F.when(doc % 5 != 0, F.concat(F.lit("from "), "lang")).alias("description"), F.col("lang").alias("language"),
        F.when(doc % 7 != 0, F.col("n_chars")).alias("stargazers_count"),
        F.when(doc % 3 != 0, F.array("lang", F.concat(F.lit("t"), doc % 10))).alias("topics"),
        F.when(doc % 4 != 0, F.struct(F.lit("MIT").alias("spdx_id"))).alias("license"),
        (doc % 6 == 0).alias("archived"),
    ]
    if with_owner:
        fields += [F.when(doc % 9 != 0, F.struct(F.col("source").alias("login"))).alias("owner"),
                   F.when(doc % 8 != 0, F.struct(F.col("lang").alias("path"))).alias("namespace")]
    return o.table("documents").select(F.to_json(F.struct(*fields)).alias("payload"), F.col("source").alias("asked_org"))


_NORMALIZED = """
SELECT doc_id AS repo_id, source AS org, source AS name, full_name, description, lang AS language,
       CAST(stars AS INT) AS stars_count, 0 AS forks_count, 0 AS watchers_count, 0 AS open_issues_count,
       '' AS default_branch, '' AS html_url, {topics} AS topics, {license} AS license_type, '' AS homepage,
       {archived} AS archived, '' AS created_at, '' AS updated_at, '' AS pushed_at, '{platform}' AS source_platform
FROM fx_api"""


@query("normalize_payload", Documents, O + _PAYLOAD_SQL + _NORMALIZED.format(
    topics="topics", license="license_type", archived="(doc_id % 6 = 0)", platform="github",
) + "\nUNION ALL" + _NORMALIZED.format(topics="''", license="''", archived="FALSE", platform="gitee"))
def _(o):
    payloads = _payloads(o, with_owner=False)
    return payload.normalize_payload(payloads, "github", org="asked_org").unionByName(
        payload.normalize_payload(payloads, "gitee", org="asked_org")
    )


@query("search_owner", Documents, """
SELECT doc_id AS repo_id, 'github' AS source_platform, CASE WHEN doc_id % 9 = 0 THEN '' ELSE source END AS org
FROM documents
UNION ALL
SELECT doc_id, 'gitee', CASE WHEN doc_id % 8 = 0 THEN '' ELSE lang END FROM documents""")
def _(o):
    payloads = _payloads(o, with_owner=True)
    rows = payload.normalize_payload(payloads, "github").unionByName(payload.normalize_payload(payloads, "gitee"))
    return rows.select("repo_id", "source_platform", "org")


@query("write_raw_dated", Documents, O + f"SELECT {COLUMNS}, '{DAY}' AS dt FROM fx_raw")
def _(o):
    folder = scratch_dir(o.spark, "dated")
    raw.write_raw_dated(o.raw, folder, DAY)
    return raw.read_raw_dated(o.spark, folder).select(*_FIELDS, "dt")


@query("write_read_clean", Documents, O + f"SELECT {COLUMNS} FROM fx_raw")
def _(o):
    folder = scratch_dir(o.spark, "clean")
    store.write_clean(o.raw.withColumn("star_range", F.lit("0")).withColumn("created_year", F.lit(2020)), folder)
    return store.read_clean(o.spark, folder)


@query("load_ods_partition", Documents, O + """
SELECT repo_id, full_name, stars_count, '2026-08-06' AS dt FROM fx_raw
UNION ALL
SELECT repo_id, full_name, stars_count + 1 AS stars_count, '2026-08-07' AS dt FROM fx_raw""")
def _(o):
    """Two days, the second one loaded twice with other numbers."""
    warehouse = store.Warehouse(o.spark, scratch_dir(o.spark, "ods"))
    more = o.raw.withColumn("stars_count", F.col("stars_count") + 1)
    for day, rows in (("2026-08-06", o.raw), ("2026-08-07", o.raw), ("2026-08-07", more)):
        warehouse.replace_days("ods_repos_raw", clean.normalize_ods(rows, day), [day])
    return warehouse.read("ods_repos_raw").select("repo_id", "full_name", "stars_count", "dt")


@query("resume_ingest_stream", Documents, O + f"""
SELECT repo_id, full_name, {_DESCRIPTION} AS description, {_LANGUAGE} AS language, source_platform, dt FROM (
  SELECT *, '2026-08-06' AS dt FROM fx_raw
  UNION ALL SELECT * REPLACE (org || '/new' AS full_name), '2026-08-07' AS dt FROM fx_raw)
WHERE NOT {_ARCHIVED} AND NOT {_SPAM} AND NOT ({_ON_GITEE} AND regexp_matches(coalesce(description, ''), '(?i)迁移|migrated'))""")
def _(o):
    """Two days land one after the other; each run of the stream loads the day that is new."""
    folder, progress = scratch_dir(o.spark, "landing"), scratch_dir(o.spark, "progress")
    warehouse = store.Warehouse(o.spark, scratch_dir(o.spark, "ods"))
    renamed = o.raw.withColumn("full_name", F.concat("org", F.lit("/new")))
    for day, rows in {"2026-08-06": o.raw, "2026-08-07": renamed}.items():
        raw.write_raw_arrays(rows, f"{folder}/landed{day}", day, _collected_from())
        ingest_new_files(o.spark, folder, warehouse, progress, marts=False, names="part-*")
    return warehouse.read("ods_repos_raw").select(
        "repo_id", "full_name", "description", "language", "source_platform", "dt"
    )


_DONE = "SELECT DISTINCT org_name FROM fx_fact WHERE snapshot_date <= DATE '2024-01-01' AND stars_count > 100"


@query("resume_ingest", Events, Events.SQL + f""",
done AS ({_DONE}),
collected AS (SELECT project_id, org_name, language, 0 AS phase FROM fx_dim WHERE org_name IN (SELECT org_name FROM done)),
fresh AS (SELECT project_id, org_name, 'fresh' AS language, 1 AS phase FROM fx_dim
          WHERE org_name NOT IN (SELECT org_name FROM done))
SELECT project_id, org_name, language FROM (
  SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY phase) AS rn
  FROM (SELECT * FROM collected UNION ALL SELECT * FROM fresh)) WHERE rn = 1""")
def _(e):
    done = e.fact.filter("snapshot_date <= DATE '2024-01-01' AND stars_count > 100").select("org_name").distinct()
    rows = e.dim.select("project_id", "org_name", "language")
    return selection.resume(
        e.dim.select("org_name").distinct(), done, rows.join(done, "org_name", "left_semi"),
        rows.withColumn("language", F.lit("fresh")), ["org_name"], ["project_id"], ["org_name"],
    ).select("project_id", "org_name", "language")


_WATCHED = {"gitee": ["NATION_0", "NATION_2", "NATION_7"], "github": ["NATION_1", "NATION_4", "NATION_21"]}


@query("track_orgs", Events, Events.SQL + """
SELECT * FROM fx_fact WHERE (source_platform = 'gitee' AND org_name IN ('NATION_0', 'NATION_2', 'NATION_7'))
   OR (source_platform = 'github' AND org_name IN ('NATION_1', 'NATION_4', 'NATION_21'))""".replace(
    "SELECT *", "SELECT project_id, org_name, source_platform, CAST(snapshot_date AS VARCHAR) AS snapshot_date, "
    "stars_count, forks_count, watchers_count, open_issues_count"))
def _(e):
    return selection.track_orgs(e.fact, _WATCHED, org="org_name")


_WORDS = ["license", "Copyright", "en", "src1", "zzz"]


@query("keyword_pick", Documents, O + """
SELECT keyword, repo_id, stars_count FROM (
  SELECT k.keyword, r.repo_id, r.stars_count,
         row_number() OVER (PARTITION BY k.keyword ORDER BY r.stars_count DESC, r.repo_id) AS rn
  FROM fx_raw r JOIN (VALUES ('license'), ('Copyright'), ('en'), ('src1'), ('zzz')) k(keyword)
    ON contains(lower(coalesce(r.full_name, '')), lower(k.keyword))
    OR contains(lower(coalesce(r.description, '')), lower(k.keyword)))
WHERE rn <= 100""")
def _(o):
    picked = selection.keyword_pick(o.raw, _WORDS, ["full_name", "description"], rows=100)
    return picked.select("keyword", "repo_id", "stars_count")


@query("gen_dim_date", Lines, """
SELECT CAST(d AS VARCHAR)[1:10] AS date_id, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter,
       CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day, CAST(weekofyear(d) AS INT) AS week_of_year,
       CAST(isodow(d) AS INT) AS day_of_week, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""")
def _(l):
    """The calendar over the time the repositories were created in."""
    day = F.col("o_orderdate").cast("date")
    return calendar.calendar_of(l.table("orders").agg(F.min(day).alias("first"), F.max(day).alias("last")))


@query("fill_missing_columns", Documents, O + """
SELECT repo_id, full_name, description, '' AS topics, '' AS license, '' AS homepage, archived,
       'unknown' AS source_platform FROM fx_raw""")
def _(o):
    rows = o.raw.select("repo_id", "full_name", "description", "archived")
    return clean.fill_missing_columns(rows)


_LINE_ORDER = "l_shipdate, l_partkey, l_suppkey, l_extendedprice"


def _line_dedup(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in _LINE_ORDER.split(", "))
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM lineitem)
WHERE rn = 1"""


_LINE_FIELDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("dedup_first", Lines, _line_dedup("ASC"))
def _(l):
    rows = l.table("lineitem").select(*_LINE_FIELDS, "l_shipdate")
    return dedup.keep_one(rows, ["l_orderkey", "l_linenumber"], _LINE_ORDER.split(", ")).select(*_LINE_FIELDS)


@query("dedup_last", Lines, _line_dedup("DESC"))
def _(l):
    rows = l.table("lineitem").select(*_LINE_FIELDS, "l_shipdate")
    return dedup.keep_one(rows, ["l_orderkey", "l_linenumber"], _LINE_ORDER.split(", "), "last").select(*_LINE_FIELDS)


_PHASES = """,
phases AS (
  SELECT repo_id, source_platform, full_name, 'org' AS found_by, 1 AS phase FROM fx_raw WHERE language <> ''
  UNION ALL
  SELECT repo_id, source_platform, full_name, 'search' AS found_by, 2 AS phase FROM fx_raw)"""


def _phases(o):
    fields = ["repo_id", "source_platform", "full_name"]
    by_org = o.raw.filter("language <> ''").select(*fields, F.lit("org").alias("found_by"))
    return by_org, o.raw.select(*fields, F.lit("search").alias("found_by"))


@query("dedup_collect", Documents, O + _PHASES + """
SELECT repo_id, source_platform, full_name, found_by FROM (
  SELECT *, row_number() OVER (PARTITION BY repo_id, source_platform ORDER BY phase) AS rn FROM phases)
WHERE rn = 1""")
def _(o):
    return dedup.dedup_phases(_phases(o), ["repo_id", "source_platform"], ["full_name"])


@query("union_phases", Documents, O + _PHASES + "SELECT * FROM phases")
def _(o):
    return dedup.union_phases(*_phases(o))


@query("fill_description", Documents, O + f"SELECT repo_id, {_DESCRIPTION} AS description FROM fx_raw")
def _(o):
    return clean.fill_description(o.raw).select("repo_id", "description")


@query("drop_migrated", Documents, O + f"SELECT {COLUMNS} FROM fx_raw WHERE NOT {_MIGRATED}")
def _(o):
    return clean.drop_migrated(o.raw, PATTERN)


@query("drop_archived", Documents, O + f"SELECT {COLUMNS} FROM fx_raw WHERE NOT {_ARCHIVED}")
def _(o):
    return clean.drop_archived(o.raw)


@query("drop_spam", Documents, O + f"SELECT {COLUMNS} FROM fx_raw WHERE NOT {_SPAM}")
def _(o):
    return clean.drop_spam(o.raw)


@query("truncate_text", Documents, O + """
SELECT repo_id, substring(description, 1, 15000) AS description, substring(full_name, 1, 5) AS full_name FROM fx_raw""")
def _(o):
    rows = o.raw.select("repo_id", "description", "full_name")
    return clean.truncate_text(rows, {"description": V.DESCRIPTION_MAX, "full_name": 5, "html_url": V.NAME_MAX})


@query("fill_language", Documents, O + f"SELECT repo_id, {_LANGUAGE} AS language FROM fx_raw")
def _(o):
    return clean.fill_language(o.raw).select("repo_id", "language")


@query("topics_to_string", Documents, O + """
SELECT repo_id, CASE repo_id % 4 WHEN 0 THEN org || ', ' || language WHEN 1 THEN org || ', x' WHEN 2 THEN '' ELSE ''
  END AS topics FROM fx_raw""")
def _(o):
    doc = F.col("repo_id") % 4
    topics = (
        F.when(doc == 0, F.to_json(F.array("org", "language"))).when(doc == 1, F.concat("org", F.lit(", x")))
        .when(doc == 2, "[]")
    )
    rows = o.raw.withColumn("topics", topics).select("repo_id", "topics")
    return rows.withColumn("topics", text.topics_to_text(F.col("topics")))


@query("normalize_ods_row", Documents, O + f"""
SELECT repo_id, org, '' AS name, full_name, substring(coalesce(description, ''), 1, 15000) AS description,
       stars_count, 0 AS forks_count, 0 AS watchers_count, 0 AS open_issues_count, {_LANGUAGE} AS language,
       '' AS default_branch, '' AS html_url, '' AS topics,
       CASE WHEN repo_id % 2 = 0 THEN 'A' || repo_id % 4 ELSE 'B' END AS license_type, '' AS homepage,
       CASE WHEN archived THEN 1 ELSE 0 END AS archived, '' AS created_at, '' AS updated_at, '' AS pushed_at,
       source_platform, '{DAY}' AS dt
FROM fx_raw""")
def _(o):
    even = F.col("repo_id") % 2 == 0
    rows = o.raw.withColumn("license_type", F.when(even, F.concat(F.lit("A"), F.col("repo_id") % 4)).otherwise(""))
    return clean.normalize_ods(rows.withColumn("license", F.lit("B")), DAY)


# Records landed twice: the second copy comes later and is longer.
_TWICE = """,
twice AS (
  SELECT *, 1 AS seq FROM fx_raw
  UNION ALL
  SELECT * REPLACE (description || ' again' AS description), 2 AS seq FROM fx_raw WHERE repo_id % 3 = 1),
uniq AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY repo_id, source_platform ORDER BY seq) AS rn FROM twice) WHERE rn = 1)"""


def _twice(o):
    again = o.raw.filter("repo_id % 3 = 1").withColumn("description", F.concat("description", F.lit(" again")))
    return o.raw.withColumn("seq", F.lit(1)).unionByName(again.withColumn("seq", F.lit(2)))


@query("clean_repos", Documents, O + _TWICE + f"""
SELECT repo_id, org, full_name, {_DESCRIPTION} AS description, {_LANGUAGE} AS language, source_platform, archived,
       stars_count, '' AS topics, '' AS license, '' AS homepage
FROM uniq WHERE NOT {_MIGRATED} AND NOT {_ARCHIVED} AND NOT {_SPAM}""")
def _(o):
    return clean.clean_repos(_twice(o), ["seq"], PATTERN).drop("seq")


@query("clean_audit", Documents, O + _TWICE + f""",
flags AS (SELECT *, {_MIGRATED} AS m, {_ARCHIVED} AS a, {_SPAM} AS s, {_BLANK} AS b, {_ON_GITEE} AS gitee,
                 (language IS NULL OR language = '') AS nolang FROM uniq)
SELECT (SELECT count(*) FROM twice) AS original, (SELECT count(*) FROM twice) - count(*) AS duplicates,
       count(*) AS unique_rows, count(*) FILTER (b) AS empty_descriptions, count(*) FILTER (m) AS migrated,
       count(*) FILTER (a) AS archived, count(*) FILTER (m OR a) AS invalid,
       count(*) FILTER (NOT m AND NOT a AND s) AS spam,
       count(*) FILTER (NOT m AND NOT a AND NOT s AND nolang AND gitee) AS no_language_gitee,
       count(*) FILTER (NOT m AND NOT a AND NOT s AND nolang AND coalesce(source_platform = 'github', FALSE))
         AS no_language_github,
       count(*) FILTER (NOT m AND NOT a AND NOT s) AS kept
FROM flags""")
def _(o):
    return clean.clean_audit(_twice(o), ["seq"], PATTERN)


@query("month_of_text", Lines, Lines.SQL + "SELECT repo_id, left(created_at, 7) AS month FROM fx_ods")
def _(l):
    return l.ods.select("repo_id", text.month_of_text(F.col("created_at")).alias("month"))


@query("parse_created_at", Lines, Lines.SQL + """
SELECT repo_id, strftime(strptime(left(created_at, 19), '%Y-%m-%dT%H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS created_at
FROM fx_ods WHERE repo_id % 5 <> 0
UNION ALL SELECT repo_id, NULL FROM fx_ods WHERE repo_id % 5 = 0""")
def _(l):
    written = F.when(F.col("repo_id") % 5 == 0, "no time").otherwise(F.col("created_at"))
    return l.ods.select("repo_id", text.parse_created_at(written).alias("created_at"))


@query("not_blank", Lines, Lines.SQL + """
SELECT repo_id, created_at FROM fx_ods WHERE repo_id % 3 <> 0 AND repo_id % 5 <> 0""")
def _(l):
    key = F.col("repo_id")
    created = F.when(key % 3 == 0, None).when(key % 5 == 0, "").otherwise(F.col("created_at"))
    return l.ods.select("repo_id", created.alias("created_at")).filter(text.not_blank(F.col("created_at")))
