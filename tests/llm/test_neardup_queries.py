"""Near duplicates and components: what the driver has to run for them, and rows that tie groups together."""
import pytest

from repodw.llm import neardup, stages
from repodw.llm.components import components


def jobs(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def words(first, many=60):
    return " ".join(f"w{first + k}" for k in range(many))


@pytest.fixture()
def docs(spark):
    """Copies, near copies, and texts of their own."""
    rows = [(k, words(100 * (k // 3)) + (" and" if k % 3 == 2 else "")) for k in range(30)]
    return spark.createDataFrame([*rows, *[(k, words(100_000 + 100 * k)) for k in range(30, 60)]], "doc_id long, text string")


def test_near_duplicates_take_few_jobs(spark, docs):
    rows, many = jobs(spark, "near-duplicates", lambda: neardup.near_duplicates(docs).collect())
    assert {r["doc_id"]: r["component_id"] for r in rows} == {k: k // 3 * 3 if k < 30 else k for k in range(60)}
    assert many <= 75
    left, many = jobs(spark, "stage", lambda: stages.drop_near_duplicates(spark, docs, "").collect())
    assert {r["doc_id"] for r in left} == {r["doc_id"] for r in rows if r["kept"]} and many <= 90


def test_texts_of_their_own_take_no_components(spark):
    docs = spark.createDataFrame([(k, words(1000 * k)) for k in range(20)], "doc_id long, text string")
    rows, many = jobs(spark, "own-texts", lambda: neardup.near_duplicates(docs).collect())
    assert all(r["kept"] and r["component_id"] == r["doc_id"] for r in rows) and len(rows) == 20 and many <= 45


def test_a_round_of_components_takes_few_jobs(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(0, 40, 2)], "a long, b long")
    found, many = jobs(spark, "pairs-of-nodes", lambda: dict(map(tuple, components(links).collect())))
    assert found == {k: k // 2 * 2 for k in range(40)} and many <= 20


def test_components_of_loops_and_repeated_links(spark):
    links = spark.createDataFrame([(5, 5), (9, 8), (9, 8), (8, 9), (7, 7), (7, 9)], "a long, b long")
    assert sorted(map(tuple, components(links).collect())) == [(5, 5), (7, 7), (8, 7), (9, 7)]
    loops = spark.createDataFrame([(5, 5), (5, 5), (3, 3)], "a long, b long")
    assert sorted(map(tuple, components(loops).collect())) == [(3, 3), (5, 5)]


def test_ids_that_repeat_tie_the_groups_of_their_texts(spark):
    """10, 11 and 12 are in two groups each, so four groups are one; 13 is in one group twice; 30 stays alone."""
    group = [words(1000 * k) for k in range(6)]
    rows = [(1, group[0]), (2, group[1]), (3, group[2]), (4, group[3]), (5, group[4] + " end"), (30, group[5]),
            (10, group[0] + " more"), (10, group[1]), (11, group[1] + " more"), (11, group[2]), (12, group[3]), (12, group[2] + " too"),
            (13, group[4]), (13, group[4] + " more"), (None, group[0]), (40, ""), (41, None)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in found} == {
        **dict.fromkeys([1, 2, 3, 4, 10, 11, 12], 1), **dict.fromkeys([5, 13], 5), 30: 30, 40: 40, 41: 41, None: None}
    assert {r["doc_id"] for r in found if r["kept"]} == {1, 5, 30, 40, 41, None}
