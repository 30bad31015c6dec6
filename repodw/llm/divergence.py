"""Source divergence audit: how the sources of a language differ in their use of terms.

Arrow kernels inside mapInArrow lower-case the texts, split them, encode the terms as numbers and count them by row and
by (language, source); Spark adds these partial counts up. Terms of enough documents are kept. A language's kept terms
are dealt by hash into shards of some SHARD_TERMS, and each shard comes with all sources of the language: it holds its
counts as columns by term, compares the sources pairwise and finds every source's leading terms. Sums over shards and
a ranking finish both. So no language, source or term has to fit into one task; a shard holds a row per term and source,
and is worked through in blocks of CELLS numbers.

All arithmetic is on whole numbers; counts may reach 10^15.

Nulls and odd input: a null text, language or source is empty text, and counted with those that are empty. Ids don't
matter, every row is a document. A group without terms has pairs and no terms; a language without kept terms has pairs
of value 0, one with a single source none. Ties are settled by name. An empty table gives an empty result; further
columns are ignored. Texts of any length are counted whole, in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repodw.session import written

LEAST_DOCUMENTS = 30
SCALE = 1_000_000_000
PRIOR = 5
BEST = 50
SHARD_TERMS = 1 << 10
# Numbers of a shard compared in one go.
CELLS = 1 << 20
# Bytes of text split in one go.
PIECE = 1 << 22
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_COUNTS = "lang string, source string, term string, n long, docs long"
_FOUND = "lang string, source string, part string, item string, value long"


def _terms(text: pa.Array) -> pa.Table:
    """row, term, n: the counted terms of every text."""
    lists = pc.split_pattern_regex(pc.ascii_lower(text), BETWEEN)
    coded = pc.list_flatten(lists).dictionary_encode()
    table = pa.table({"row": pc.list_parent_indices(lists), "code": coded.indices})
    counts = table.group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
    out = pa.table({"row": counts["row"], "term": coded.dictionary.take(counts["code"].combine_chunks()), "n": counts["count_all"]})
    return out.filter(pc.not_equal(out["term"], ""))


def _cut(text: str) -> Iterator[str]:
    """A long text in pieces that end between terms."""
    data = text.encode("utf-8", "surrogatepass")
    letters = _LETTER[np.frombuffer(data, np.uint8)]
    first = 0
    while first < len(data):
        last = min(first + PIECE, len(data))
        gaps = np.flatnonzero(~letters[first:last])
        if last < len(data):
            if len(gaps):
                last = first + int(gaps[-1]) + 1
            else:  # a term longer than a piece goes whole
                after = np.flatnonzero(~letters[last:])
                last = last + int(after[0]) if len(after) else len(data)
        yield data[first:last].decode("utf-8", "surrogatepass")
        first = last


def _of_rows(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, pa.Table]]:
    """Rows of some PIECE bytes of text, or a single longer one, with their counted terms."""
    lengths = pc.binary_length(batch["text"]).to_numpy()
    first = 0
    while first < len(lengths):
        upto = np.cumsum(lengths[first:first + 100_000])
        many = max(int(np.searchsorted(upto, PIECE, side="right")), 1)
        rows = batch.slice(first, many)
        if upto[0] <= PIECE:
            yield rows, _terms(rows["text"])
        else:
            parts = [_terms(pa.array([piece])) for piece in _cut(rows["text"][0].as_py())]
            whole = pa.concat_tables(parts).group_by(["row", "term"], use_threads=False).aggregate([("n", "sum")])
            yield rows, whole.rename_columns({"n_sum": "n"})
        first += many


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, terms in _of_rows(batch):
            at, coded = terms["row"].combine_chunks(), terms["term"].combine_chunks().dictionary_encode()
            table = pa.table({"lang": rows["lang"].take(at), "source": rows["source"].take(at), "term": coded.indices, "n": terms["n"]})
            sums = table.group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
            out = pa.table({"lang": sums["lang"], "source": sums["source"], "term": coded.dictionary.take(sums["term"].combine_chunks()),
                            "n": sums["n_sum"], "docs": sums["count_all"]})
            yield from out.to_batches()


def shares(counts: np.ndarray, total: np.ndarray | int, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * kept)), exact: the scale is multiplied in by thousands."""
    below = np.asarray(total + PRIOR * kept, np.int64)
    whole, rest = np.divmod(np.asarray(counts, np.int64) + PRIOR, below)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, below)
        whole = whole * 1000 + more
    return whole + 1


def _diverged(best: int):
    def run(counts: pa.Table, groups: pa.Table) -> pa.Table:
        """The pairs' distances over this shard's terms, and the leading terms of every source."""
        lang, kept = groups["lang"][0].as_py(), groups["kept"][0].as_py()
        groups = groups.sort_by("source")
        names, totals = groups["source"].combine_chunks(), groups["total"].to_numpy()
        many = len(totals)
        terms = pc.unique(counts["term"])
        terms = terms.take(pc.sort_indices(terms))
        column = pc.index_in(counts["term"], terms).to_numpy()
        row = pc.index_in(counts["source"], names).to_numpy()
        n = counts["n"].to_numpy()
        apart = np.zeros((many, many), np.int64)
        leading: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        width = max(CELLS // max(many, 1), 1)
        for first in range(0, len(terms), width):
            size = min(width, len(terms) - first)
            here = (column >= first) & (column < first + size)
            block = np.zeros((many, size), np.int64)
            block[row[here], column[here] - first] = n[here]
            p = shares(block, totals[:, None], kept)
            for k in range(many - 1):
                apart[k, k + 1:] += np.abs(p[k + 1:] - p[k]).sum(axis=1)
            ahead = np.where(block > 0, p - shares(block.sum(axis=0), int(totals.sum()), kept), 0)
            for k in range(many):
                some = np.flatnonzero(ahead[k] > 0)
                some = some[np.argsort(-ahead[k, some], kind="stable")[:best]]
                leading.append((np.full(len(some), k), some + first, ahead[k, some]))
        a, b = np.triu_indices(many, 1)
        both = (np.concatenate([a, b]), np.concatenate([b, a]), np.tile(apart[a, b], 2))
        which, item, value = (np.concatenate([x[i] for x in leading] or [np.zeros(0, np.int64)]) for i in range(3))
        parts = [pa.table({"lang": pa.repeat(lang, len(v)), "source": names.take(pa.array(s)), "part": pa.repeat(part, len(v)),
                           "item": of.take(pa.array(i)), "value": pa.array(v, pa.int64())})
                 for part, of, (s, i, v) in (("pair", names, both), ("term", terms.cast(pa.string()), (which, item, value)))]
        return pa.concat_tables([p.cast(pa.schema([(c, pa.string()) for c in ("lang", "source", "part", "item")] + [("value", pa.int64())]))
                                 for p in parts])

    return run


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, best: int = BEST) -> DataFrame:
    """lang, source, part, item, value, rank: the distance of every pair of a language's sources, and the terms that every
    source uses more than its language."""
    empty = F.lit("")
    rows = docs.select(*[F.coalesce(c, empty).alias(c) for c in ("lang", "source", "text")])
    by_group = rows.mapInArrow(_partial_counts, _COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    counts = by_group.select(
        "lang", "source", "term", "n", F.sum("docs").over(of_term).alias("spread"),
        (F.row_number().over(of_term.orderBy("source")) == 1).cast("long").alias("first"))
    counts = written(counts.filter(F.col("spread") >= least).drop("spread"), "terms")
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("first").alias("first"))
    found = rows.groupBy("lang", "source").agg(F.lit(0).cast("long").alias("none"))
    groups = found.join(sums, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("first", F.lit(0)).alias("first"))
    groups = written(groups.select("lang", "source", "total", F.sum("first").over(Window.partitionBy("lang")).alias("kept")), "groups")
    shards = F.greatest(F.ceil(F.col("kept") / SHARD_TERMS), F.lit(1))
    by_lang = groups.groupBy("lang").agg(F.first("kept").alias("kept")).select("lang", shards.alias("shards"))
    dealt = counts.join(by_lang, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("shards")).alias("shard"), "source", "term", "n")
    everywhere = groups.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), (shards - 1).cast("long"))))
    results = written(dealt.groupBy("lang", "shard").cogroup(everywhere.groupBy("lang", "shard")).applyInArrow(_diverged(best), _FOUND), "diverged")
    pairs = results.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    terms = results.filter("part = 'term'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    ranked = pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms)
    return ranked.select("lang", "source", "part", "item", "value", "rank")
