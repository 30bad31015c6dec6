"""Document fingerprints: a Merkle tree over the pieces, paragraphs and sections of a text.

A paragraph is a line; its pieces are runs of up to 12 words that end early at the end of a sentence. A piece's hash is
of its characters, a paragraph's of its pieces' hashes, a section's of its paragraphs', the root's of all sections'. A
section ends at a paragraph whose hash begins with 0 or 1, or after 32, so that an edit moves no later sections. The
fingerprint writes the tree down, root first: `root;section=paragraph:piece,piece|paragraph:...;section=...`.

Equal roots mean equal texts; where roots differ, sections, then paragraphs, then pieces that differ locate the edit.
The likeness of two fingerprints is the share of distinct piece hashes they have in common, 2 * |both| / (|a| + |b|).

Nulls and odd input: a null text is empty; an empty text has a root and nothing below, and is like another empty one.
In `edited`, ids that repeat are ordered by text, a null doc_id comes last, and a single document is followed by
itself. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repodw.llm.common import text_or_empty

PIECE = r"(?:[^ ]*[^ .!?] +){0,11}[^ ]+ *| +"
SECTION = r"(?:[2-9a-f][^|]*\|){0,31}[^|]+\|?"
# Buckets of neighbouring ids: at most so many, each of some ROWS documents.
BUCKETS = 16384
ROWS = 500


def _short(text: Column) -> Column:
    return F.substring(F.md5(text), 1, 16)


def _paragraph(line: Column) -> Column:
    """The hashes of its pieces."""
    return F.array_join(F.transform(F.regexp_extract_all(line, F.lit(PIECE), F.lit(0)), _short), ",")


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """The rows with the fingerprint of a text column."""
    pieces = F.transform(F.split(F.col(text), "\n"), _paragraph)
    rows = rows.withColumn("_paragraphs", F.transform(pieces, lambda p: F.concat(_short(p), F.lit(":"), p)))
    sections = F.regexp_extract_all(F.array_join("_paragraphs", "|"), F.lit(SECTION), F.lit(0))
    rows = rows.withColumn("_sections", F.transform(sections, lambda s: F.concat(_short(s), F.lit("="), F.rtrim(s, F.lit("|")))))
    body = F.array_join("_sections", ";")
    whole = F.when(F.col(text) == "", F.sha2(F.lit(""), 256)).otherwise(F.concat(F.sha2(body, 256), F.lit(";"), body))
    return rows.withColumn(name, whole).drop("_paragraphs", "_sections")


def root(fingerprint: Column) -> Column:
    return F.substring_index(fingerprint, ";", 1)


def _leaves(fingerprint: Column) -> Column:
    """The distinct piece hashes: what follows a colon or comma."""
    return F.array_distinct(F.regexp_extract_all(fingerprint, F.lit("[:,]([0-9a-f]{16})"), F.lit(1)))


def likeness(a: Column, b: Column) -> Column:
    x, y = _leaves(a), _leaves(b)
    both = F.size(F.array_intersect(x, y))
    total = F.size(x) + F.size(y)
    return F.when(root(a) == root(b), 1.0).when(total == 0, 0.0).otherwise(2.0 * both / F.greatest(total, F.lit(1)))


def differing_sections(a: Column, b: Column) -> Column:
    """The sections of a, by number from 1, that b has not: where a was edited."""
    mine = F.transform(F.slice(F.split(a, ";"), 2, 1 << 30), lambda s: F.substring_index(s, "=", 1))
    theirs = F.transform(F.slice(F.split(b, ";"), 2, 1 << 30), lambda s: F.substring_index(s, "=", 1))
    numbered = F.transform(mine, lambda s, i: F.struct((i + 1).alias("number"), s.alias("hash")))
    return F.transform(F.filter(numbered, lambda s: ~F.array_contains(theirs, s["hash"])), lambda s: s["number"])


def with_next(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """doc_id, text, next: the text of the document after, by descending doc_id; after the last, the first.

    Texts are shuffled once, by buckets of neighbouring ids. Each bucket also gets the first document of the bucket
    after it, as a guard that is dropped once the rows before it have seen it.
    """
    spark = docs.sparkSession
    plain = docs.select("doc_id", text_or_empty(F.col("text")).alias("text"))
    facts = plain.agg(F.count("*").alias("n"), F.count("doc_id").alias("ids")).first()
    wanted = max(1, min(BUCKETS, facts["ids"] // rows))
    bounds = sorted(set(plain.approxQuantile("doc_id", [k / wanted for k in range(1, wanted)], 0.2 / wanted))) if wanted > 1 else []
    # Two looks of some square root of the bounds each.
    step = max(1, int(len(bounds) ** 0.5))
    groups = [[str(int(b)) for b in bounds[k:k + step]] for k in range(0, len(bounds), step)]
    bucket = F.lit(0)
    if groups:
        outer = F.split(F.lit(",".join(g[0] for g in groups)), ",").cast("array<bigint>")
        inner = F.split(F.lit(";".join(map(",".join, groups))), ";")
        plain = plain.withColumn("group", F.size(F.filter(outer, lambda b: b <= F.col("doc_id"))))
        mine = F.split(F.get(inner, F.col("group") - 1), ",").cast("array<bigint>")
        plain = plain.withColumn("mine", mine)
        place = F.size(F.filter("mine", lambda b: b <= F.col("doc_id")))
        bucket = F.when(F.col("group") == 0, 0).otherwise((F.col("group") - 1) * step + place)
    bucket = F.when(F.col("doc_id").isNull(), -1).otherwise(bucket)
    plain = plain.withColumn("bucket", bucket).select("doc_id", "text", "bucket")
    # The greatest id of each bucket that has rows, greatest bucket first: the id after a bucket's last.
    firsts = plain.groupBy("bucket").agg(F.max("doc_id").alias("first")).orderBy(F.col("bucket").desc()).collect()
    after = [(firsts[k - 1]["bucket"], firsts[k]["first"]) for k in range(len(firsts))]
    guards = spark.createDataFrame(after, "guarded int, first long") if after else spark.createDataFrame([], "guarded int, first long")
    marked = plain.withColumn("guard", F.lit(0))
    copies = plain.join(F.broadcast(guards), F.col("doc_id").eqNullSafe(F.col("first"))).groupBy("guarded").agg(
        F.min(F.struct("text")).alias("t")).select(
        F.lit(None).cast("long").alias("doc_id"), F.col("t.text").alias("text"), F.col("guarded").alias("bucket"), F.lit(1).alias("guard"))
    order = Window.partitionBy("bucket").orderBy("guard", F.col("doc_id").desc_nulls_last(), "text")
    both = marked.withColumn("doc_id", F.col("doc_id").cast("long")).unionByName(copies)
    return both.withColumn("next", F.lead("text").over(order)).filter("guard = 0").select("doc_id", "text", "next")


def edited(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, text, next, edited: the last third replaced by as much of the next document's beginning."""
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    return with_next(docs).select("doc_id", n.cast("long").alias("n_chars"), "text", "next", F.concat(
        F.substring("text", F.lit(1), n - third), F.substring("next", F.lit(1), third)).alias("edited"))
