"""Plain versions of sums that the operators spread over tasks."""
from fractions import Fraction

import numpy as np
import pytest
from brute import fold
from pyspark.sql import functions as F

from repodw.llm import mix, quality

FOLDER = "/root/testdata/sf0.01"


def _filled(sizes, weights=(5, 2, 1), most=3):
    """Water filling by its end state: the level at which capped shares add up to all words."""
    w, caps, whole = [weights[k % 3] for k in range(len(sizes))], [most * s for s in sizes], sum(sizes)
    full = sorted({Fraction(c, x) for c, x in zip(caps, w)})
    for level in [*full, None]:
        closed = [k for k in range(len(sizes)) if level is None or Fraction(caps[k], w[k]) < level]
        open_ = [k for k in range(len(sizes)) if k not in closed]
        if not open_:
            return [float(c) for c in caps]
        height = Fraction(whole - sum(caps[k] for k in closed), sum(w[k] for k in open_))
        if all(Fraction(caps[k], w[k]) >= height for k in open_) and all(Fraction(caps[k], w[k]) <= height for k in closed):
            return [float(caps[k]) if k in closed else float(height * w[k]) for k in range(len(sizes))]
    raise AssertionError


@pytest.mark.parametrize("sizes", [[10], [0], [5, 5, 5], [1, 100, 100], [1000, 1, 1, 1, 50], [7, 0, 90, 3, 3, 400, 2], [1, 1, 10**9]])
def test_targets_equal_water_filling(sizes):
    found = mix.targets(sizes)
    assert found == pytest.approx(_filled(sizes)) and sum(found) == pytest.approx(sum(sizes))
    assert all(t <= 3 * s + 1e-6 for t, s in zip(found, sizes))


def test_many_sources(spark):
    """100,000 sources of one document each: every target is met, none beyond three times its size."""
    docs = spark.range(100_000).select(F.col("id").alias("doc_id"), F.format_string("s%06d", "id").alias("source"),
                                       F.repeat(F.lit("w "), (F.col("id") % 7).cast("int")).alias("text"))
    rows = mix.takings(mix.placed(docs)).select("source", "size", "target", "taken").toPandas()
    assert len(rows) == 100_000 and (abs(rows["taken"] - rows["target"]) <= 1).all() and (rows["taken"] <= 3 * rows["size"]).all()


def test_quality_model_equals_one_sum_over_all_rows(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect() if fold(r["doc_id"])}
    ids = sorted(labels)
    x = np.array([quality.statistics(texts[i] or "") for i in ids])
    y = np.array([labels[i] for i in ids], float)
    hashed = spark.createDataFrame([(i,) for i in ids], "doc_id long").select(
        "doc_id", F.pmod(F.xxhash64(F.lit(quality.SEED), "doc_id"), F.lit(2)).alias("h")).collect()
    half = np.array([h for _, h in sorted(map(tuple, hashed))])
    rows = spark.createDataFrame([(i, *map(float, r), int(q)) for i, r, q in zip(ids, x, y)], ["doc_id", *quality.STATISTICS, "label"])
    model = quality.fit(rows.repartition(5))

    spread = x.std(axis=0)
    z = np.clip((x - x.mean(axis=0)) / np.where(spread > 1e-9, spread, 1.0), -8, 8)
    f = np.hstack([np.cos(z @ model.project + model.shift) * np.sqrt(2 / quality.FEATURES), np.ones((len(z), 1))])

    def ridge(some):
        return np.linalg.solve(f[some].T @ f[some] + quality.RIDGE * max(some.sum(), 1) * np.eye(f.shape[1]), f[some].T @ y[some])

    assert model.weights == pytest.approx(ridge(np.ones(len(y), bool)), rel=1e-4, abs=1e-5)
    raw = np.where(half == 0, f @ ridge(half == 1), f @ ridge(half == 0))
    at = np.clip((raw + 0.5) * quality.BINS / 2, 0, quality.BINS - 1).astype(int)
    bins = sorted(set(at))
    n, right = (np.array([v[at == b].sum() for b in bins]) for v in (np.ones(len(y)), y))
    mean = lambda a, b: right[a:b + 1].sum() / n[a:b + 1].sum()
    # The best rising fit, by its min-max formula.
    best = [max(min(mean(a, b) for b in range(k, len(bins))) for a in range(k + 1)) for k in range(len(bins))]
    places = np.array([raw[at == b].mean() for b in bins])
    steps = dict(zip(np.round(model.steps[1], 6), model.steps[0]))
    assert sorted(steps) == pytest.approx(sorted(set(np.round(best, 6))), abs=2e-6) and (np.diff(model.steps[1]) > 0).all()
    assert model.steps[0].min() >= places.min() - 1e-6 and model.steps[0].max() <= places.max() + 1e-6
