"""Quality classifier: random Fourier features, ridge by partition-summed normal equations, isotonic calibration.

A text is described by `STATISTICS` of its whole length: sizes, shares of kinds of characters, of repeated words, lines
and sentences, of letters in upper case, and so on. Cosines of random projections of these (random Fourier features)
approximate a Gaussian kernel. Every partition sums its features' outer products; the sums are added up in a tree and
the ridge weights solve the normal equations. The sums are kept for two halves of the labelled rows, so that each half
is also scored by weights fitted on the other; an isotonic function of these scores, fitted on bins of them, gives
probabilities.

All labelled rows are used; what is gathered is a matrix per partition and counts per bin. Only statistics are
shuffled, never texts.

Nulls and odd input: a null text is empty, and an empty text has statistics of 0 and is scored like any other. A null
label or doc_id is not learned from. Labels that repeat a doc_id each count. Without labels of both classes every text
scores the share of label 1 (0.5 if there is none). An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repodw.session import written

FEATURES = 256
WIDTH = 3.0
RIDGE = 1e-3
BINS = 512
SEED = 5
THRESHOLD = 0.3
# Characters looked at in one go, so that memory doesn't grow with the length of a text.
PIECE = 1 << 20
STATISTICS = (
    "log_words", "log_lines", "word_length", "upper", "digits", "blank", "points", "signs", "bars", "bangs", "non_ascii",
    "capital_words", "shouted_words", "signed_words", "digit_words", "distinct_words", "top_word", "distinct_lines",
    "distinct_sentences", "line_length", "ended_lines", "short_words", "long_words", "distinct_letters", "echoed_words")

_KINDS = np.zeros(256, np.int64)
for _kind, _chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\r\x0b\x0c", ".,;:?'\"-", "#$%&*+/<=>@\\^_`{}~()[]", "|", "!"), 1):
    _KINDS[[ord(c) for c in _chars]] = _kind
_KINDS[128:] = 8
_SIGNED = re.compile(r"[#$%&*@^~]{2,}")


def statistics(text: str) -> list[float]:
    """The numbers of `STATISTICS`, in their order."""
    kinds, letters = np.zeros(9), np.zeros(256)
    words: Counter[str] = Counter()
    for first in range(0, len(text), PIECE):
        counts = np.bincount(np.frombuffer(text[first:first + PIECE].encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
        letters += counts
    np.add.at(kinds, _KINDS, letters)
    listed = text.split()
    words.update(listed)
    size, n = max(letters.sum(), 1), max(sum(words.values()), 1)
    lines = [line for line in text.split("\n") if line]
    sentences = [s for s in re.split(r"[.!?\n]+ ?", text) if s]
    share = lambda test: sum(c for w, c in words.items() if test(w)) / n
    present = letters[letters > 0] / size
    return [
        np.log1p(sum(words.values())), np.log1p(len(lines)), sum(len(w) * c for w, c in words.items()) / n,
        kinds[1] / size, kinds[2] / size, kinds[3] / size, kinds[4] / size, kinds[5] / size, kinds[6] / size, kinds[7] / size, kinds[8] / size,
        share(lambda w: w[0].isupper()), share(lambda w: len(w) > 1 and w.isupper()), share(lambda w: bool(_SIGNED.search(w))),
        share(lambda w: any(map(str.isdigit, w))), len(words) / n, max(words.values(), default=0) / n,
        len(set(lines)) / max(len(lines), 1), len(set(sentences)) / max(len(sentences), 1), np.log1p(len(text) / max(len(lines), 1)),
        sum(line[-1] in ".!?" for line in lines) / max(len(lines), 1), share(lambda w: len(w) < 3), share(lambda w: len(w) > 12),
        float(-(present * np.log(present)).sum()), sum(map(str.__eq__, listed, listed[1:])) / n]


def described(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of the text, a row per document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([statistics(t or "") for t in batch["text"]], columns=STATISTICS, dtype=float)
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{s} double" for s in STATISTICS))


class Model:
    """Scale of the statistics, random projections, ridge weights and the steps of the calibration."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        draw = np.random.default_rng(SEED)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.project = draw.normal(size=(len(STATISTICS), FEATURES)) / WIDTH
        self.shift = draw.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.steps = (np.array([0.0]), np.array([0.5]))

    def features(self, frame: pd.DataFrame) -> np.ndarray:
        x = np.clip((frame[list(STATISTICS)].to_numpy() - self.mean) / self.spread, -8, 8)
        return np.hstack([np.cos(x @ self.project + self.shift) * np.sqrt(2 / FEATURES), np.ones((len(x), 1))])

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, *self.steps)


def _solved(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.linalg.solve(gram + RIDGE * max(gram[-1, -1], 1) * np.eye(len(gram)), right)


def isotonic(score: np.ndarray, right: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and heights of the rising steps that fit the mean labels best (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for s, r, n in zip(score, right, count):
        blocks.append([s * n, r, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(labelled: DataFrame) -> Model:
    """From the statistics and a label 0 or 1 (column `label`)."""
    facts = labelled.agg(F.count("*").alias("n"), F.sum("label").alias("yes"), *[f(s).alias(f"{s}_{name}") for s in STATISTICS
                         for f, name in ((F.mean, "m"), (F.stddev_pop, "s"))]).first()
    n, yes = facts["n"], facts["yes"] or 0
    model = Model(*[np.array([facts[f"{s}_{name}"] or 0.0 for s in STATISTICS]) for name in "ms"])
    if not 0 < yes < n:
        model.steps = (np.array([0.0]), np.array([yes / n if n else 0.5]))
        return model
    half = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(2)).cast("int")
    rows = labelled.select(*STATISTICS, F.col("label").cast("double").alias("label"), half.alias("half"))
    size = FEATURES + 1

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
        total = np.zeros((2, size, size + 1))
        for batch in batches:
            x, y, h = model.features(batch), batch["label"].to_numpy(), batch["half"].to_numpy()
            for k in (0, 1):
                total[k] += np.hstack([x[h == k].T @ x[h == k], (x[h == k].T @ y[h == k])[:, None]])
        yield total

    def frames(rows_: Iterator) -> Iterator[pd.DataFrame]:
        buffer = []
        for row in rows_:
            buffer.append(tuple(row))
            if len(buffer) == 4096:
                yield pd.DataFrame(buffer, columns=[*STATISTICS, "label", "half"])
                buffer = []
        if buffer:
            yield pd.DataFrame(buffer, columns=[*STATISTICS, "label", "half"])

    # One matrix per partition, added up in a tree, so that no task and not the driver meets more than a few.
    total = rows.rdd.mapPartitions(lambda it: sums(frames(it))).treeReduce(lambda a, b: a + b, 3)
    halves = [_solved(total[1 - k][:, :-1], total[1 - k][:, -1]) for k in (0, 1)]
    model.weights = _solved(total.sum(0)[:, :-1], total.sum(0)[:, -1])

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = np.where(batch["half"] == 0, *(model.features(batch) @ w for w in halves))
            place = np.clip((raw + 0.5) * BINS / 2, 0, BINS - 1).astype(int)
            yield pd.DataFrame({"bin": place, "raw": raw, "label": batch["label"]}).groupby("bin", as_index=False).agg(
                raw=("raw", "sum"), right=("label", "sum"), n=("label", "size"))

    bins = rows.mapInPandas(binned, "bin long, raw double, right double, n long").groupBy("bin").agg(
        F.sum("raw").alias("raw"), F.sum("right").alias("right"), F.sum("n").alias("n")).orderBy("bin").toPandas()
    model.steps = isotonic((bins["raw"] / bins["n"]).to_numpy(), bins["right"].to_numpy(), bins["n"].to_numpy())
    return model


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """The rows' doc_id with score and predicted."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            score = model.probability(model.features(batch) @ model.weights)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": score, "predicted": (score >= THRESHOLD).astype(np.int32)})

    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score, predicted of every document, learned from labels (doc_id, label)."""
    rows = written(described(docs), "statistics")
    known = labels.filter("label IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_id"), "label")
    return scored(rows, fit(written(rows.join(known, F.col("doc_id") == F.col("_id")).drop("_id"), "labelled")))
