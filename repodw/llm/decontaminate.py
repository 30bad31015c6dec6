"""Benchmark decontamination: finds windows of benchmark words in training documents.

Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters. A window is `width` consecutive words
of an item; an item of fewer words, but not none, is one window. The distinct windows, hashes and words but no item ids,
are broadcast in blocks of bounded rows and bytes, every word position of every document probes them, and a probe that
meets a hash is verified word by word within the same stage, so a collision of hashes is never a hit. Only hits are
shuffled; the items that hold a window are joined to the verified hits afterwards, however many share it.

Nulls and odd input: a null or wordless text has no words and no hits; an empty or null item has no window; a null
item_id is left out of the lists but its windows hit. Rows that repeat a doc_id with the same text give one row; with
another text, a row of their own. Empty tables give empty results, or documents without hits. Further columns of
either table are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repodw.llm.common import ascii_lower, merged_length, text_or_empty
from repodw.session import written

BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PIECE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x60\x7B-\x7F]+$"
WIDTH = 10
# Windows, and bytes of their words, in one broadcast. More are looked for block by block.
BLOCK = 500_000
BLOCK_BYTES = 64 << 20


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text_or_empty(text)), BREAK), "")


def windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """item_id and window (its words), a row for each place."""
    words = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
    words = words.withColumn("n", F.size("words")).filter("n > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.col("n") - (width - 1), F.lit(1)))
    return words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, width))).alias("window"))


def _name(window: Column) -> Column:
    """Names a window in 128 bits; words hold no blank."""
    return F.md5(F.array_join(window, " ").cast("binary"))


def holders(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """name of a window and item_id, for every item that holds it."""
    return windows(items, width).filter("item_id IS NOT NULL").select(_name(F.col("window")).alias("name"), "item_id").distinct()


def hits(docs: DataFrame, items: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """doc_id, text_hash, n_words, start, len, name: a row per verified hit, and one with start 0 per document."""
    known = written(windows(items, width).select("window").distinct().select(
        F.xxhash64("window").alias("h"), "window", _name(F.col("window")).alias("name")), "windows")
    facts = known.agg(F.count("*").alias("n"), F.collect_set(F.size("window")).alias("lengths"),
                      F.sum(F.octet_length(F.array_join("window", " "))).alias("bytes")).first()
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    words = words.withColumn("n_words", F.size("words"))

    # Explode, hash, join and filter run as one generated loop over start positions, which refers to the words of the
    # document and copies them for no position. explode_outer, because explode lets the optimizer infer a filter that
    # takes the words apart once more; no higher-order function, as slice in one costs as much as the whole text.
    starts = words.select("*", F.explode_outer(F.sequence(F.lit(0), F.col("n_words"))).alias("start"))
    lengths = F.array(*[F.lit(n) for n in sorted(facts["lengths"]) or [width]])
    probes = starts.select("*", F.explode_outer(lengths).alias("len"))
    here = F.slice("words", F.greatest("start", F.lit(1)), F.col("len"))
    whole = (F.col("start") > 0) & (F.col("start") + F.col("len") <= F.col("n_words") + 1)
    probes = probes.withColumn("at", F.when(whole, F.xxhash64(here)))
    # Two comparisons instead of an equality, which would make the words a part of the hashed key of every probe.
    real = (F.col("h") == F.col("at")) & (F.col("window") <= here) & (F.col("window") >= here)
    blocks = max(1, -(-facts["n"] // block), -(-(facts["bytes"] or 0) // BLOCK_BYTES))

    def scan(number: int) -> DataFrame:
        part = known.filter(F.pmod("h", F.lit(blocks)) == number) if blocks > 1 else known
        met = probes.join(F.broadcast(part), real, "left").filter((F.col("start") == 0) | F.col("name").isNotNull())
        return met.select("doc_id", "text_hash", "n_words", "start", "len", "name")

    return reduce(DataFrame.unionByName, map(scan, range(blocks)))


def _per_document(found: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_words, spans of words that are hit, names of the windows."""
    span = F.struct(F.col("start").alias("start"), (F.col("start") + F.col("len")).alias("end"))
    return found.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").cast("long").alias("n_words"), F.collect_set(F.when(F.col("start") > 0, span)).alias("spans"),
        F.collect_set("name").alias("names"))


def report(docs: DataFrame, items: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (ids sorted as strings), spans of words, contaminated."""
    per_doc = written(_per_document(hits(docs, items, width, block)), "hits")
    held = per_doc.filter(F.size("names") > 0).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.explode("names").alias("name")).join(holders(items, width), "name")
    listed = held.groupBy("_id", "_hash").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return per_doc.join(listed, same, "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>"))).select(
        "doc_id", "text_hash", "n_words", merged_length(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), "items", "spans", (F.size("spans") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, remove: str = "documents", width: int = WIDTH) -> DataFrame:
    """The documents without those that hold a hit (remove="documents") or without the hit words ("spans")."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove={remove!r}")
    bad = _per_document(hits(docs, items, width)).filter(F.size("spans") > 0).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("spans").alias("_spans"))
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_hash"))
    if remove == "documents":
        return docs.join(bad, same, "left_anti")
    pieces = F.regexp_extract_all(F.col("text"), F.lit(PIECE), F.lit(0))
    kept = F.filter(pieces, lambda p, i: ~F.exists("_spans", lambda s: (s["start"] <= i + 1) & (i + 1 < s["end"])))
    cut = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(F.array_join(kept, ""))
    return docs.join(bad, same, "left").select(*[cut.alias(c) if c == "text" else docs[c] for c in docs.columns])
