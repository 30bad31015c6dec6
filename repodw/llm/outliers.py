"""Quality rules: base rules, and robust multivariate outliers by language and source.

Every text is described by counts of its words, characters, signs and repeats, taken from the whole text. Five transformed
statistics of these (`transformed`) form a vector. For every pool of documents (a language and source; small ones share
their language's pool, or one for all) the minimum covariance determinant is estimated: the mean and covariance of the
COVERED share of vectors with the smallest determinant. Concentration steps approach it from three starts, the best start
is taken, and the estimate is refined on the vectors that it finds near. A vector whose squared Mahalanobis distance
passes CUT is rejected.

A concentration step is one aggregation: vectors are counted and summed by bins of their present distance (eight to an
octave), and the lowest bins that cover the share give the next mean and covariance. So a pool of any size, also one with
a third of all rows, is combined in the tasks that hold it; nothing is sorted or collected, and only numbers are shuffled.
Vectors are whole numbers of 1/10000 with exact sums, so results don't depend on the order of rows. FLOORS are added to
the variances, so that a statistic that hardly varies in a pool (no signs at all, say) doesn't reject small departures.

Nulls and odd input: a null text has no words and fails the base rules. Null languages and sources are groups of their
own. Rows are judged one by one; repeated rows and null ids have a row each. In a pool of equal rows all distances are 0.
An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import add, sub

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repodw.llm.common import text_or_empty
from repodw.session import written

BLANKS = " \t\n\x0b\x0c\r"
SIGNS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50
# Documents a pool needs to have estimates of its own.
LEAST_POOL = 100
COVERED = 0.75
STEPS = 6
UNIT = 10_000
# Estimates (three a pool at first) that are broadcast at most; more are joined by a shuffle.
BROADCAST_POOLS = 100_000
# Least standard deviation of each statistic, in the order of `transformed`.
FLOORS = (0.5, 0.08, 0.06, 0.08, 0.08)
SIZE = len(FLOORS)
# Fixed values of the chi-squared distribution with 5 degrees of freedom: the factor that makes the covariance of the
# nearest 75 % consistent, the 97.5 % quantile, and the factor for the vectors below it.
NEAREST_FACTOR = 1.4121
NEAR = 12.8325
NEAR_FACTOR = 1.0555
# Squared distance beyond which a vector is rejected: exceeded with probability 1e-5 under the normal distribution.
CUT = 30.856


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of every row."""
    text = F.col("text")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    rows = docs.select("doc_id", "lang", "source", text_or_empty(F.col("text")).alias("text"))
    return rows.select(
        "doc_id", "lang", "source",
        _with(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated(w).alias("repeated"))).alias("w"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SIGNS, ""))).cast("long").alias("n_symbols"),
        _with(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).alias("distinct"))).alias("l"),
    ).select("doc_id", "lang", "source", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", F.col("l.n").alias("n_lines"),
             (F.col("l.n") - F.col("l.distinct")).alias("n_dup_lines"), F.col("w.repeated").alias("n_repeat_words"))


def _with(value: Column, use) -> Column:
    """use(value), with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeated(words: Column) -> Column:
    """Words covered by 3-word windows found twice or more: equal windows are neighbours once sorted."""
    windows = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.struct(F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i")))

    def places(found: Column) -> Column:
        same = lambda x, k: (x["w"] == F.get(found, k - 1)["w"]) | (x["w"] == F.get(found, k + 1)["w"])
        return F.sort_array(F.transform(F.filter(found, same), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        each = F.transform(at, lambda i, k: F.least(F.coalesce(F.get(at, k + 1) - i, F.lit(3)), F.lit(3)))
        return F.aggregate(each, F.lit(0).cast("long"), lambda total, n: total + n)

    return _with(_with(F.sort_array(windows), places), covered)


def transformed() -> list[Column]:
    """Log of words, log of the mean word length, root of the signs' share, share of repeated lines, of repeated words."""
    words = F.greatest("n_words", F.lit(1))
    return [F.log1p("n_words"), F.log(F.greatest("word_chars", F.lit(1)) / words),
            F.sqrt(F.col("n_symbols") / F.greatest("word_chars", F.lit(1))),
            F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), F.col("n_repeat_words") / words]


def _pools(rows: DataFrame, least: int) -> DataFrame:
    """The pool of each language and source."""
    groups = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.col("n") < least
    rest = F.sum(F.when(small, F.col("n")).otherwise(0)).over(Window.partitionBy("lang"))
    # To json, so that a null differs from any text.
    return groups.select("lang", "source", F.when(~small, F.concat(F.lit("2"), F.to_json(F.struct("lang", "source"))))
                         .when(rest >= least, F.concat(F.lit("1"), F.to_json(F.struct("lang")))).otherwise("0").alias("pool"))


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(SIZE) for j in range(i + 1)]


def _sums() -> list[Column]:
    """Exact: whole numbers, added up as decimals."""
    ones = [F.sum(F.col(f"x{i}").cast("decimal(20,0)")).alias(f"s{i}") for i in range(SIZE)]
    twos = [F.sum((F.col(f"x{i}") * F.col(f"x{j}")).cast("decimal(20,0)")).alias(f"s{i}{j}") for i, j in _pairs()]
    return [F.count("*").alias("n"), *ones, *twos]


def _added() -> list[Column]:
    return [F.sum(c).alias(c) for c in ["n", *[f"s{i}" for i in range(SIZE)], *[f"s{i}{j}" for i, j in _pairs()]]]


def _estimate(sums: DataFrame, factor: float, keys: list[str]) -> DataFrame:
    """Mean m, inverse w of the covariance's Cholesky factor, and log determinant, from the sums of a set of vectors."""
    mean = {f"m{i}": F.col(f"s{i}").cast("double") / F.col("n") / UNIT for i in range(SIZE)}
    out = sums.withColumns(mean)
    cov = {f"c{i}{j}": factor * (F.col(f"s{i}{j}").cast("double") / F.col("n") / UNIT / UNIT - F.col(f"m{i}") * F.col(f"m{j}"))
           + (FLOORS[i] ** 2 if i == j else 0.0) for i, j in _pairs()}
    return _inverted(out.withColumns(cov), keys)


def _inverted(out: DataFrame, keys: list[str]) -> DataFrame:
    for i, j in _pairs():
        rest = reduce(sub, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.col(f"c{i}{j}"))
        # Never below a part of the floor, whatever rounding leaves.
        entry = rest / F.col(f"l{j}{j}") if j < i else F.sqrt(F.greatest(rest, F.lit(1e-3 * FLOORS[i] ** 2)))
        out = out.withColumn(f"l{i}{j}", entry)
    for j in range(SIZE):
        for i in range(j, SIZE):
            value = F.lit(1.0) if i == j else -reduce(add, [F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)])
            out = out.withColumn(f"w{i}{j}", value / F.col(f"l{i}{i}"))
    return out.select(*keys, *[f"m{i}" for i in range(SIZE)], *[f"w{i}{j}" for i, j in _pairs()],
                      reduce(add, [F.log(f"l{i}{i}") for i in range(SIZE)]).alias("volume"))


def _distance() -> Column:
    """Squared, of x from m."""
    apart = [F.col(f"x{i}") / UNIT - F.col(f"m{i}") for i in range(SIZE)]
    return reduce(add, [F.pow(reduce(add, [F.col(f"w{i}{j}") * apart[j] for j in range(i + 1)]), F.lit(2.0)) for i in range(SIZE)])


def _small(pools: DataFrame) -> DataFrame:
    """Broadcast if few enough, by count, so that vectors aren't dealt by pool; `pools` must be written."""
    return F.broadcast(pools) if pools.count() <= BROADCAST_POOLS else pools


def _concentrated(vectors: DataFrame, estimates: DataFrame, keys: list[str]) -> DataFrame:
    """The estimates of the nearest COVERED share: one concentration step."""
    octave = F.log2(F.greatest(_distance(), F.lit(2.0 ** -10)))
    bins = vectors.join(_small(estimates), "pool").groupBy(*keys, F.floor(8 * F.least(octave, F.lit(40.0))).alias("bin")).agg(*_sums())
    whole = Window.partitionBy(*keys)
    nearer = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    inside = bins.withColumns({"before": F.coalesce(F.sum("n").over(nearer), F.lit(0)), "all": F.sum("n").over(whole)})
    inside = inside.filter(F.col("before") < F.ceil(COVERED * F.col("all")))
    return _estimate(inside.groupBy(*keys).agg(*_added()), NEAREST_FACTOR, keys)


def _medians(vectors: DataFrame) -> DataFrame:
    """Median of every statistic, to a hundredth, as m0 ... by pool."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.round(F.col(f"x{i}") / (UNIT / 100)).cast("long").alias("v")) for i in range(SIZE)]))
    counts = vectors.select("pool", each.alias("e")).groupBy("pool", "e.i", "e.v").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("pool", "i").orderBy("v")
    passed = counts.withColumns({"reach": F.sum("n").over(upto), "all": F.sum("n").over(Window.partitionBy("pool", "i"))})
    middle = passed.filter((2 * F.col("reach") >= F.col("all")) & (2 * (F.col("reach") - F.col("n")) < F.col("all")))
    return middle.groupBy("pool").agg(*[(F.max(F.when(F.col("i") == i, F.col("v"))) / 100.0).alias(f"m{i}") for i in range(SIZE)])


def _starts(vectors: DataFrame) -> DataFrame:
    """All rows' mean and covariance; the medians with that covariance; the medians with the floors alone."""
    keys = ["pool"]
    all_rows = _estimate(vectors.groupBy("pool").agg(*_sums()), 1.0, keys)
    medians = _medians(vectors)
    centred = all_rows.drop(*[f"m{i}" for i in range(SIZE)]).join(medians, "pool")
    diagonal = {f"c{i}{j}": F.lit(FLOORS[i] ** 2 if i == j else 0.0) for i, j in _pairs()}
    plain = _inverted(medians.withColumns(diagonal), keys)
    return reduce(DataFrame.unionByName, [e.withColumn("start", F.lit(k)) for k, e in enumerate((all_rows, centred, plain))])


def estimates(vectors: DataFrame) -> DataFrame:
    """By pool, the reweighted minimum covariance determinant estimate of vectors (pool, x0 ... in units of 1/UNIT)."""
    found = written(_starts(vectors), "starts")
    for _ in range(STEPS):
        found = written(_concentrated(vectors, found.drop("volume"), ["pool", "start"]), "step")
    names = [c for c in found.columns if c not in ("pool", "start", "volume")]
    best = found.groupBy("pool").agg(F.min_by(F.struct(*names), F.struct("volume", "start")).alias("e")).select("pool", "e.*")
    near = vectors.join(_small(written(best, "best")), "pool").filter(_distance() <= NEAR)
    return written(_estimate(near.groupBy("pool").agg(*_sums()), NEAR_FACTOR, ["pool"]).drop("volume"), "estimates")


def judged(docs: DataFrame, least: int = LEAST_POOL, cut: float = CUT) -> DataFrame:
    """The counts of every document, base_failed, distance (squared, to its pool's estimate) and kept."""
    rows = written(counted(docs), "counted")
    pools = _pools(rows, least)
    keyed = rows.alias("r").join(pools.alias("p"), F.col("r.lang").eqNullSafe(F.col("p.lang")) & F.col("r.source").eqNullSafe(F.col("p.source")))
    vectors = {f"x{i}": F.round(value * UNIT).cast("long") for i, value in enumerate(transformed())}
    rows = written(keyed.select("r.*", "pool").withColumns(vectors), "vectors")
    vectors = rows.select("pool", *[f"x{i}" for i in range(SIZE)])
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    out = rows.join(_small(estimates(vectors)), "pool", "left").withColumns({"base_failed": failed, "distance": F.coalesce(_distance(), F.lit(0.0))})
    return out.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance",
                      (~F.col("base_failed") & (F.col("distance") <= cut)).alias("kept"))
