"""Every query against its SQL, values and types."""
import duckdb
import pytest

from helpers import TESTDATA

import __spark_entry__ as entry
from repodw.checks import registry

FOLDER = f"{TESTDATA}/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, sql, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = sql.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    types = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields}
    assert types == {c[0]: str(c[1]) for c in cursor.description}
    expected = sorted((tuple(row) for row in cursor.fetchall()), key=repr)
    actual = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
    assert actual == expected


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema
    assert first.count() == 14


def test_ordered_results_are_ordered(spark):
    stars = [r["starsCount"] for r in entry.queries()["q_repos"](spark, FOLDER).collect()]
    assert stars == sorted(stars, reverse=True)
    ranks = [r["ranking"] for r in entry.queries()["q_ranking"](spark, FOLDER).collect()]
    assert ranks == list(range(1, len(ranks) + 1))
