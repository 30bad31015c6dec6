"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets. Sources in code point order, null last, weigh 5, 2, 1, repeating, and share the words of all documents by
   weight; a target stops at `most` times its source's size and the excess is reshared by weight until none is above.
2. Blocks. A document's permuted place in its source is a hash of its id and text; equal stretches of places are the blocks of a
   source. A target of r times the size takes floor(r) whole passes over the source, then documents in permuted order
   while they fit, and of the one that doesn't fit so many leading words as there is room for. Where that happens is
   found by sums over stretches of places, then over stretches of the stretch that doesn't fit, and so on.
3. Tree. The exact block quotas of all sources are split in two, half of the output shards each, by a multivariate
   hypergeometric draw, and again within each half. Every node draws from a generator seeded by its path, so a shard's
   quotas don't depend on the task that works them out: one task per subtree of some 64 shards, which finds its way down
   from the root. Going through the shards in order, each takes the next
   disjoint stretch of a source's permuted blocks (a new permutation for each pass).
4. Each shard shuffles its documents locally, by a hash.

Only sums per source, block quotas and shard quotas are gathered; documents are joined with the plan of blocks on
(source, block), so that a source with a third of all rows is spread over all its blocks.

Nulls and odd input: a null text has size 0; a null source is a source of its own, after all others; a null doc_id is
one like any other. Repeated rows are mixed one by one; `takings` gives rows that share doc_id, source and size as one. An empty table, or one without words, gives no takings. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repodw.llm.common import text_or_empty
from repodw.session import written

WEIGHTS = (5, 2, 1)
MOST = 3
# The cut of a source's last pass is looked for in so many stretches of places, so many times over.
STRETCHES = 1024
LEVELS = 3
# Words of a block, or more where that would make over MOST_BLOCKS blocks of the whole input; words of an output shard.
BLOCK_WORDS = 50_000
MOST_BLOCKS = 1 << 20
SHARD_WORDS = 5_000_000
SEED = 17
SPACE = r"[\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """The number of runs of non-blank characters."""
    return F.size(F.array_remove(F.split(text_or_empty(text), SPACE), "")).cast("long")


def leading(text: Column, words: Column) -> Column:
    """The first words of the text, joined by blanks."""
    return F.array_join(F.slice(F.array_remove(F.split(text_or_empty(text), SPACE), ""), F.lit(1), words.cast("int")), " ")


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> list[float]:
    """Words to take of each source, the sources being in order."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    out, rest, left = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while left:
        total = sum(weight[i] for i in left)
        above = {i for i in left if rest * weight[i] / total > most * sizes[i]}
        if not above:
            for i in left:
                out[i] = rest * weight[i] / total
            break
        for i in above:
            out[i] = float(most * sizes[i])
        rest -= sum(most * sizes[i] for i in above)
        left -= above
    return out


def split_quotas(quotas: np.ndarray, shards: int, seed: int = SEED) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, blocks of each source), summing to the quotas; shards differ by at most one block."""
    for shard, _, draw in subtree(quotas, shards, seed):
        yield shard, draw


def subtree(quotas: np.ndarray, shards: int, seed: int = SEED, node: int = 1) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, blocks of each source before it, its blocks) for the shards below a node of the tree. The root is node 1, and
    2n and 2n + 1 are below n. Draws are seeded by node, so the way down from the root is the same in every task."""
    all_blocks = int(quotas.sum())

    def halves(first: int, last: int, total: np.ndarray, before: int, path: int) -> tuple[int, int, np.ndarray]:
        middle = (first + last) // 2
        room = int(all_blocks * middle // shards) - before
        return middle, room, np.random.default_rng((seed, path)).multivariate_hypergeometric(total, room, method="marginals")

    def split(first: int, last: int, total: np.ndarray, before: int, path: int, offset: np.ndarray):
        if last - first == 1:
            yield first, offset, total
            return
        middle, room, draw = halves(first, last, total, before, path)
        yield from split(first, middle, draw, before, 2 * path, offset)
        yield from split(middle, last, total - draw, before + room, 2 * path + 1, offset + draw)

    first, last, before, path = 0, shards, 0, 1
    total, offset = quotas.astype(np.int64), np.zeros(len(quotas), np.int64)
    for right in map(int, bin(node)[3:]):
        if last - first == 1:  # a single shard is below its leftmost node alone
            if right:
                return
            continue
        middle, room, draw = halves(first, last, total, before, path)
        if right:
            first, before, total, offset = middle, before + room, total - draw, offset + draw
        else:
            last, total = middle, draw
        path = 2 * path + right
    yield from split(first, last, total, before, path, offset)


def placed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, place: the permuted place within the source, from 0 to 2^62; and row, where docs have a key _mix_row."""
    # By text as well, so that rows under one id, or without any, are spread like others.
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text"), 2)
    # Rows that share a place are ordered by text, then by key.
    row = [F.struct(F.xxhash64("text").alias("hash"), F.col("_mix_row").alias("key")).alias("row")] if "_mix_row" in docs.columns else []
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), size_of(F.col("text")).alias("size"), place.alias("place"), *row)


def sources(docs: DataFrame) -> list[dict]:
    """Per source in order: name, size, target. As many rows as there are sources."""
    rows = docs.groupBy("source").agg(F.sum("size").alias("size")).orderBy(F.col("source").asc_nulls_last()).collect()
    wanted = targets([r["size"] for r in rows])
    return [{"n": n, "source": r["source"], "size": r["size"], "target": t} for n, (r, t) in enumerate(zip(rows, wanted))]


def level(depth: int, blocks: int = STRETCHES) -> Column:
    """The stretch that holds the place, at a depth from 1."""
    return F.expr(f"place div {max(1, (1 << 62) // blocks ** depth)}")


def cuts(docs: DataFrame, found: list[dict], stretches: int = STRETCHES, levels: int = LEVELS) -> DataFrame:
    """n, rest, stretch: all documents in stretches before this one, and `rest` words in it, end a source's last pass."""
    spark = docs.sparkSession
    state = spark.createDataFrame(
        [(s["n"], s["target"] - s["size"] * int(s["target"] // max(s["size"], 1)), 0) for s in found],
        "n int, rest double, stretch long")
    for depth in range(1, levels + 1):
        # At most one row a source.
        inside = docs.join(F.broadcast(state), "n").filter(
            F.lit(True) if depth == 1 else level(depth - 1, stretches) == F.col("stretch"))
        sums = inside.groupBy("n", "rest", level(depth, stretches).alias("at")).agg(F.sum("size").alias("size"))
        order = Window.partitionBy("n").orderBy("at")
        run = sums.withColumn("upto", F.sum("size").over(order))
        # The first stretch that doesn't fit whole; at most `stretches` rows a source.
        first = run.filter(F.col("upto") > F.col("rest")).groupBy("n").agg(
            F.min(F.struct("at", (F.col("rest") - F.col("upto") + F.col("size")).alias("rest"))).alias("cut"))
        state = spark.createDataFrame(
            [(r["n"], r["cut"]["rest"], r["cut"]["at"]) for r in first.collect()], "n int, rest double, stretch long")
    return state


def mixture(docs: DataFrame, found: list[dict] | None = None, stretches: int = STRETCHES, levels: int = LEVELS,
            block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """The mix: doc_id, source, size, words (so many leading ones), pass, shard, position in the shard.

    `docs` as `placed` gives them; their row, where they have it, is kept.
    """
    own = ["row"] if "row" in docs.columns else []
    spark = docs.sparkSession
    found = sources(docs) if found is None else found
    block_words = max(block_words, -(-sum(s["size"] for s in found) // MOST_BLOCKS))
    width = [(1 << 62) // max(1, -(-s["size"] // block_words)) + 1 for s in found]
    names = spark.createDataFrame([(s["n"], s["source"], w) for s, w in zip(found, width)], "n int, name string, width long")
    docs = docs.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("name"))).withColumn("block", F.expr("place div width")).drop("name", "width")
    cut = cuts(docs, found, stretches, levels).withColumnsRenamed({"stretch": "last", "rest": "words"})
    passes = spark.createDataFrame([(s["n"], int(s["target"] // s["size"]) if s["size"] else 0) for s in found], "n int, passes int")

    # The last pass: all documents before the last stretch, and in it, in order of place, while there are words to take.
    deep = docs.join(F.broadcast(cut), "n", "left").withColumn("stretch", level(levels, stretches))
    order = Window.partitionBy("n").orderBy("place", "doc_id", "size", *own).rowsBetween(Window.unboundedPreceding, 0)
    at_cut = deep.filter(F.col("stretch") == F.col("last")).withColumn("upto", F.sum("size").over(order)).withColumn(
        "take", F.least("size", F.floor("words") - F.col("upto") + F.col("size")))
    row = ["n", "doc_id", "source", "size", "block", "place", "take", *own]
    partly = deep.filter(F.col("stretch") < F.col("last")).withColumn("take", F.col("size")).select(row).unionByName(
        at_cut.filter("take > 0").select(row))
    whole = docs.join(F.broadcast(passes), "n").withColumn("take", F.col("size")).select(
        *row, F.explode(F.sequence(F.lit(0), F.col("passes"))).alias("pass")).filter(F.col("pass") < F.col("passes"))
    taken = whole.unionByName(partly.join(F.broadcast(passes), "n").withColumnRenamed("passes", "pass"))

    # Block quotas of each source, and where each block of each pass goes.
    quota = taken.groupBy("n", "pass", "block").agg(F.sum("take").alias("words"))
    turn = Window.partitionBy("n").orderBy("pass", F.xxhash64(F.lit(seed), "n", "pass", "block"), "block")
    quota = written(quota.withColumn("turn", F.row_number().over(turn) - 1), "quotas")
    counts = {r["n"]: (r["k"], r["words"]) for r in quota.groupBy("n").agg(F.count("*").alias("k"), F.sum("words").alias("words")).collect()}
    quotas = np.array([counts.get(s["n"], (0, 0))[0] for s in found], np.int64)
    total = sum(w or 0 for _, w in counts.values())
    shards = max(1, min(-(-int(total) // shard_words), int(quotas.sum())))

    depth = min(10, max(0, shards.bit_length() - 6))

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for node in batch["id"]:
                for shard, offset, draw in subtree(quotas, shards, seed, int(node)):
                    some = np.flatnonzero(draw)
                    yield pd.DataFrame({"n": some.astype(np.int32), "shard": shard, "first": offset[some], "after": offset[some] + draw[some]})

    nodes = spark.range(1 << depth, 2 << depth, 1, 1 << depth)
    stretches = nodes.mapInPandas(leaves, "n int, shard int, first long, after long")
    # Each shard's stretch of a source's turns, opened into its blocks: as many rows as there are block quotas.
    opened = stretches.select("n", "shard", F.explode(F.sequence("first", F.col("after") - 1)).alias("turn"))
    plan = quota.join(opened, ["n", "turn"]).select("n", "pass", "block", "shard")
    out = taken.join(plan, ["n", "pass", "block"])
    return out.select("doc_id", "source", "size", F.col("take").alias("words"), "pass", "shard", F.xxhash64(F.lit(seed), "shard", "pass", "doc_id").alias("position"), *own)


def takings(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and shards (which the tree deals the document's passes to, sorted),
    for every document; `docs` as `placed` gives them."""
    found = sources(docs)
    mixed = mixture(docs, found).select("doc_id", "source", "size", "words", "shard")
    none = [F.lit(0).cast("long").alias("words"), F.lit(None).cast("int").alias("shard")]
    per_doc = docs.select("doc_id", "source", "size", *none).unionByName(mixed).groupBy("doc_id", "source", "size").agg(
        F.sum("words").alias("taken"), F.array_sort(F.collect_set("shard")).alias("shards"))
    facts = docs.sparkSession.createDataFrame(
        [(s["source"], s["size"], s["target"]) for s in found], "name string, source_size long, target double")
    return per_doc.join(F.broadcast(facts), F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "shards")
