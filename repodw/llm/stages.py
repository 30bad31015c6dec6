"""The operators as stages of a corpus: each takes (spark, docs, folder) and gives documents with the same columns.

Every stage handles what the operator it calls handles (see there), keeps columns it doesn't know, and gives an empty
result for an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repodw.llm import decontaminate, langid, mix, neardup, secrets
from repodw.llm.common import table
from repodw.session import small_batches, written

LANGUAGE_RARE, LANGUAGE_SHARE = 0.001, 0.5


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in a language; null texts and texts without a letter go, and so do texts whose cosine with their language's
    prototype is below a bound: `LANGUAGE_SHARE` of the cosine that all but `LANGUAGE_RARE` of the labelled documents reach.
    Prototypes are learned from the input's own labels; without any, all texts with a letter stay. `lang` is left as it is."""
    with small_batches(spark):
        model = langid.learn(docs.select("text", "lang"))
    clash = {c: f"_own_{c}" for c in ("lang_pred", "score") if c in docs.columns}
    if not model:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    with small_batches(spark):
        found = written(langid.identify(docs.withColumnsRenamed(clash), model).filter(F.col("lang_pred") != langid.UNKNOWN), "identified")
    reached = found.filter("lang IS NOT NULL").agg(F.percentile_approx("score", LANGUAGE_RARE, 100_000).alias("q")).first()["q"]
    found = found.filter(F.col("score") >= LANGUAGE_SHARE * (reached or 0.0))
    return found.drop("lang_pred", "score").withColumnsRenamed({own: c for c, own in clash.items()})


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity of at least 0.8): the least doc_id.
    Rows that repeat a doc_id stay or go together, but of rows that share id and text one stays; null ids and texts
    without words stay."""
    with small_batches(spark):
        found = neardup.near_duplicates(docs.select("doc_id", "text"))
    gone = written(found.filter("NOT kept").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    few = F.broadcast(gone) if gone.count() <= neardup.BROADCAST_ROWS else gone
    left = docs.join(few, F.col("doc_id") == F.col("_gone"), "left_anti")
    # Only rows that share id and text are shuffled.
    keys = left.groupBy(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash")).count().filter("count > 1")
    again = written(keys.drop("count"), "repeated")
    if (many := again.count()) == 0:
        return left
    again = F.broadcast(again) if many <= neardup.BROADCAST_ROWS else again
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    return left.join(again, same, "left_anti").unionByName(left.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.clean(docs, table(spark, folder, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with a mask in place of each secret; n_chars follows the text."""
    masked = secrets.clean(docs, secrets.dictionary_of(docs, table(spark, folder, "benchmark")))
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.when(F.col("text").contains(secrets.MASK), F.length("text").cast(kind)).otherwise(F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The mix: a row for each time a document is taken, with its shard, its position there and its text; a document
    taken in part has its leading words. The columns words, pass, shard and position are added; where the documents have
    one of that name already, it stays and the mix's is called mix_words and so on, with a further _ while that clashes."""
    clash = {c: f"_own{c}" for c in ("_mix_row", "_key") if c in docs.columns}
    own = docs.withColumnsRenamed(clash)
    # A key for every row, written with it: repeated ids and texts are rows of their own.
    keyed = written(own.withColumn("_mix_row", F.monotonically_increasing_id()), "keyed")
    placed = written(mix.placed(keyed), "placed")
    rows = mix.mixture(placed).select("words", "pass", "shard", "position", "size", F.col("row.key").alias("_key"))
    texts = keyed.join(rows, F.col("_mix_row") == F.col("_key"))
    leading = F.when(rows["words"] == rows["size"], keyed["text"]).otherwise(mix.leading(keyed["text"], rows["words"]))
    added = {c: c for c in ("words", "pass", "shard", "position")}
    for c in added:
        if c in docs.columns:
            added[c] = f"mix_{c}"
        while added[c] in docs.columns:
            added[c] += "_"
    return texts.select(*[(leading if c == "text" else keyed[clash.get(c, c)]).alias(c) for c in docs.columns],
                        *[rows[c].alias(name) for c, name in added.items()])
