"""Near-duplicate documents: a multi-index Hamming join of b-bit MinHash signatures, confirmed on full shingle sets.

A document's set holds its distinct runs of `width` words. Its signature is `SLOTS` minimum hashes of 16 bits each; the
distance of two signatures is the number of slots that differ. The slots are split into `CHUNKS` chunks. By the
pigeonhole principle, two signatures at a distance of at most 2 * CHUNKS - 1 (27) have a chunk with one error at most,
so each chunk is written down once for every slot that may be wrong, without that slot, and documents that share such a
key are candidates: every pair within the distance meets. A pair at a similarity of 0.8 differs in 12.8 of 64 slots on
average; that all 14 chunks have two errors or more has a probability below 1e-9.

Documents with the same set are one node from the start. Within a key, a node is first compared with one centre, the
one that shares most keys and then one picked by a hash, so a key gives one pair a node; after each round the keys whose
nodes are all in one component are done with. What remains, nodes of different components under one key, is then
paired by their rarest shingles, so that no link between components is lost. Pairs whose sizes or signatures differ too
much are dropped before the sets are fetched; all others are decided by the intersection and union of the full sets.

Nulls and odd input: without words (null, empty, blank text) the set is empty and nothing is linked, also not to other
empty ones; with fewer words than `width`, the whole sequence is the one shingle. Rows that repeat a doc_id are one
document for the links and each keep a row; a null doc_id is linked with nothing and kept. Ties go to the least doc_id.
An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repodw.llm.components import components
from repodw.llm.hashing import lots, mixed, shingles
from repodw.session import written

WIDTH = 5
PERCENT = 80
SLOTS = 64
CHUNKS = 14
ROUNDS = 2
# Signatures that differ in more slots aren't compared in full: at a similarity of 0.8, 1 pair in 10^7 is beyond.
FAR = 31
# Ids of documents that are broadcast at most (8 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 4_000_000


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * SLOTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:SLOTS], seeds[SLOTS:] | np.uint64(1)


def _chunks() -> list[np.ndarray]:
    return np.array_split(np.arange(SLOTS), CHUNKS)


def _sets(texts: list[str], width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(place of the text, its sorted distinct shingle hashes)"""
    for first, many, words, counts in lots(texts):
        hashes, runs = shingles(words, counts, width)
        ends = np.cumsum(runs)
        for k in range(many):
            yield first + k, np.unique(hashes[ends[k] - runs[k]:ends[k]])


def _digest(shingle_set: np.ndarray) -> bytes:
    return blake2b(shingle_set.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, digest of the set, signature (both null for an empty set)."""
    flip, factor = _permutations()

    def sign(shingle_set: np.ndarray) -> bytes:
        least = np.full(SLOTS, np.uint64(0xFFFFFFFFFFFFFFFF))
        for first in range(0, len(shingle_set), 4096):
            part = shingle_set[first:first + 4096]
            least = np.minimum(least, ((part[None, :] ^ flip[:, None]) * factor[:, None]).min(1))
        return (mixed(least) >> np.uint64(48)).astype(np.uint16).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(s), _digest(s) if len(s) else None, sign(s) if len(s) else None)
                    for _, s in _sets(batch.column("text").to_pylist(), width)]
            sizes, digests, signed = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signed, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "signature"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, digest binary, signature binary")


def keys(nodes: DataFrame) -> DataFrame:
    """(key, node): each chunk of the signature without one of its slots, hashed with its place."""
    chunks, order = _chunks(), mixed(np.arange(1, SLOTS + 1, dtype=np.uint64))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            slots = np.frombuffer(b"".join(batch["signature"]), np.uint16).reshape(-1, SLOTS).astype(np.uint64)
            for chunk in chunks:
                for wrong in chunk:
                    key = np.full(len(slots), order[wrong])
                    for k in chunk:
                        if k != wrong:
                            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + slots[:, k])
                    yield pd.DataFrame({"key": key.view(np.int64), "node": batch["node"].to_numpy()})

    return nodes.select("node", "signature").mapInPandas(run, "key long, node long")


def _confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough; written."""

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x, y = (np.frombuffer(b"".join(batch[c]), np.uint16).reshape(-1, SLOTS) for c in ("sa", "sb"))
                yield batch.loc[(x != y).sum(1) <= FAR, ["a", "b"]]

    sig = nodes.select("node", "signature", "n_shingles")
    a = sig.select(F.col("node").alias("a"), F.col("signature").alias("sa"), F.col("n_shingles").alias("na"))
    b = sig.select(F.col("node").alias("b"), F.col("signature").alias("sb"), F.col("n_shingles").alias("nb"))
    alike = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    pairs = written(pairs.join(a, "a").join(b, "b").filter(alike).mapInPandas(near, "a long, b long"), "pairs")
    if pairs.isEmpty():
        return pairs
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(nodes.select("node", "digest"), "node")
    sets = _full_sets(needed, docs, width)
    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("x").alias("xb")), "b").join(
        sets.select(F.col("node").alias("a"), F.col("x").alias("xa")), "a")
    both = both.withColumn("common", F.size(F.array_intersect("xa", "xb")))
    return written(both.filter(100 * F.col("common") >= percent * (F.size("xa") + F.size("xb") - F.col("common"))).select("a", "b"), "links")


def _crossing(rest: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes of different components that may be similar enough, from `rest` (node, label).

    In the order of their frequency, rarest first, two sets that are similar enough share one of their first
    n - ceil(percent * n / 100) + 1 shingles. So a passage that thousands of documents share pairs none of them. And
    they have no more in common than the shingles of either that occur in any other set at all. So thousands of copies
    of one text, each too far from it by edits of its own, pair with none either.
    """
    sets = _full_sets(rest.join(nodes.select("node", "digest"), "node").select("node", "digest"), docs, width)
    each = written(sets.select("node", F.size("x").alias("n"), F.explode("x").alias("x")), "shingles")
    often = each.groupBy("x").agg(F.count("*").alias("often"))
    order = Window.partitionBy("node").orderBy("often", "x")
    rare = each.join(often.filter("often > 1"), "x", "left").withColumn("often", F.coalesce("often", F.lit(1))).withColumns({
        "place": F.row_number().over(order), "shared": F.sum(F.when(F.col("often") > 1, 1).otherwise(0)).over(Window.partitionBy("node"))})
    rare = rare.filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).filter("often > 1")
    rare = written(rare.join(rest, "node").select("x", "node", "label", "n", "shared", "place"), "rare")
    crossed = rare.groupBy("x").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("x")
    rare = rare.join(crossed, "x")
    other = rare.select("x", F.col("node").alias("b"), F.col("label").alias("other"), F.col("n").alias("m"), F.col("shared").alias("common"), F.col("place").alias("there"))
    # From its first common shingle on, a pair has no more in common than either has left; at later ones the pair need
    # not be met again, so the same bound may drop it there.
    most = F.least("shared", "common", F.col("n") - F.col("place") + 1, F.col("m") - F.col("there") + 1)
    return rare.join(other, "x").filter("label <> other AND node < b").filter(
        100 * most >= percent * (F.col("n") + F.col("m") - most)).select(F.col("node").alias("a"), "b")


def _full_sets(needed: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """node, x: the full sets of the nodes (node, digest); written."""

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            wanted, node = batch["digest"].tolist(), batch["node"].to_numpy()
            some = [(node[k], s.view(np.int64)) for k, s in _sets(batch["text"].tolist(), width)
                    if len(s) and _digest(s) == wanted[k]]
            if some:
                yield pd.DataFrame(some, columns=["node", "x"])

    needed = written(needed, "needed")
    small = F.broadcast(needed) if needed.count() <= BROADCAST_ROWS else needed
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(small, "node")
    return written(texts.mapInPandas(fetch, "node long, x array<long>"), "sets").dropDuplicates(["node"])


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row per document."""
    signed = written(signatures(docs, width), "signatures")
    full = signed.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
    nodes = full.groupBy("digest").agg(
        F.min("doc_id").cast("long").alias("node"), F.min("signature").alias("signature"), F.min("n_shingles").alias("n_shingles"))
    nodes = written(nodes, "nodes")
    # Rows that repeat a doc_id with other texts: one of their sets stands for it, its other nodes are linked with it.
    same_set = full.join(nodes.select("digest", "node"), "digest").select(F.col("doc_id").cast("long").alias("a"), F.col("node").alias("b"))
    found = keys(nodes)
    crowded = found.groupBy("key").agg(F.count("*").alias("crowd")).filter("crowd > 1")
    members = written(found.join(crowded, "key").distinct(), "members")
    degrees = written(members.groupBy("node").agg(F.sum("crowd").alias("degree")), "degrees")

    # Until there are links, each node is on its own.
    links = nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).filter("false")
    labels = nodes.select("node", F.col("node").alias("component")).filter("false")
    for number in range(ROUNDS + 1):
        now = members.join(degrees, "node").join(labels, "node", "left").select(
            "key", "node", "degree", F.coalesce("component", "node").alias("label"))
        # First the node that shares most, the likely original of a group of copies; then another of each key.
        rank = F.col("degree") if number == 0 else F.xxhash64(F.lit(number), "node")
        open_keys = now.groupBy("key").agg(
            F.min("label").alias("low"), F.max("label").alias("high"),
            F.max(F.struct(rank.alias("rank"), F.col("node"), F.col("label"))).alias("centre")).filter("low < high")
        if number < ROUNDS:
            pairs = now.join(open_keys, "key").filter("label <> centre.label").select(
                F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b"))
        else:
            rest = written(now.join(open_keys.select("key"), "key").select("node", "label").distinct(), "rest")
            if rest.isEmpty():
                break
            pairs = _crossing(rest, docs, nodes, width, percent)
        more = _confirmed(pairs.distinct(), docs, nodes, width, percent)
        # Without a new link the labels are what they were.
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = components(links)

    owned = same_set.join(labels, F.col("b") == F.col("node"), "left").select("a", F.coalesce("component", "b").alias("b")).distinct()
    owned = written(owned, "owned")
    joined = owned.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"), F.max("b").alias("last"))
    # Components that rows of one doc_id are in are one.
    several = joined.filter("component < last").select(F.col("node").alias("a"), F.col("component").alias("least"))
    tied = written(owned.join(several, "a").filter("b <> least").select(F.col("least").alias("a"), "b").distinct(), "tied")
    if not tied.isEmpty():
        merged = components(tied).select(F.col("node").alias("component"), F.col("component").alias("whole"))
        joined = joined.join(merged, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    return signed.join(joined, signed["doc_id"] == joined["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce(F.col("component"), F.col("doc_id")).alias("component_id"),
        F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"))
