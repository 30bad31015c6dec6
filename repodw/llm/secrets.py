"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is what is assigned to a name with a word for credentials, of any length and characters; or a run of at least
16 characters out of letters, digits and `+/_-`, with up to two `=` at its end, that holds a digit or a capital after its
first character. Features: length, kinds of characters, how often they change and
their entropy, the share of the candidate's letters that lie in words of a dictionary, whether it stands in a path or
address, has the shape of a known kind of key or is itself a name that is assigned, and what stands before it: an
assignment, a quote, a word for credentials (anywhere in the name that is assigned). The forest learns from labelled
findings and scores every candidate; those at `THRESHOLD` or more are secrets.

`weak_labels` labels findings where none were labelled by hand. Secrets are values that are assigned to a name with a word
for credentials and are no words, keys of a known shape, and runs of capitals, small letters and digits of high entropy
under whatever name or none. No secrets are unassigned candidates of digits only, in a path, or mostly of dictionary
words, names that a value is assigned to, words, and numbers of under six digits. Others stay unlabelled. The forest is fitted on some `FIT_ROWS` labelled findings at most,
half of each class, drawn by hash and weighted so that classes keep their shares.

Nulls and odd input: a null or empty text has no findings. Rows that repeat doc_id and text are one document in
`findings` and are all cleaned in `clean`. With findings of one class or none, every candidate scores that class (no
label at all: 1 if the weak rule says so). An empty table gives an empty result; clean() returns exactly the columns it
is given.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repodw.llm import spans
from repodw.llm.common import ascii_lower
from repodw.session import written

# Words for credentials, shapes of keys.
CREDENTIALS = "token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth(?!or(?!i))|credential|bearer"
SHAPES = (r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_-]{20,}"
          r"|xox[abprs]-[A-Za-z0-9-]{10,}|sk[-_][A-Za-z0-9_-]{20,}|AIza[A-Za-z0-9_-]{35})$")
# Between a word for credentials and its value: the rest of the name, a sign. Characters kept before a candidate.
GIVEN = r"[\w.-]{0,32}[\"'`\]]{0,2}[ \t]{0,8}[=:]{1,2}>?[ \t]{0,8}"
# A run, its last `=` only where no value follows.
RUN = (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9]|[A-Za-z+/_-][a-z+/_-]*+[A-Z])[A-Za-z0-9+/_-]{16,}+"
       r"(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
# A value up to its closing quote; without quotes, up to a blank or separator and without closing brackets.
_QUOTED = "|".join(rf"(?<={q})[^{q}\r\n].*?(?<!(?<!\\)\\)(?={q})" for q in "\"'`")
_BARE = r"(?![=:>])[^\s\"'`,;&<>]*[^\s\"'`,;&<>)\]}.]"
VALUE = rf"(?<=[=:> \t\"'`])(?<=[=:>][ \t]{{0,8}}[\"'`]?)(?<=(?i:{CREDENTIALS}){GIVEN}[\"'`]?)(?:{_QUOTED}|{_BARE})"
CANDIDATE = rf"{VALUE}|{RUN}"
NEAR = 96
THRESHOLD = 0.5
FIT_ROWS = 20_000
TREES, DEPTH, SEED = 20, 6, 11
# Spans and dictionary words that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
MASK = "[SECRET]"

FEATURES = ("length", "digits", "upper", "signs", "changes", "distinct", "entropy", "hex", "known", "path", "shape", "name", "quoted", "assigned",
            "credential")


def _small(rows: DataFrame) -> DataFrame:
    """Broadcast if few enough, by count; `rows` must be written."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def words_of(rows: DataFrame) -> DataFrame:
    """word: the distinct runs of three lower-case letters or more in the texts, for a dictionary."""
    return rows.select(F.explode(F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(r"\p{L}{3,}+"), F.lit(0))).alias("word")).distinct()


def common_words(docs: DataFrame) -> DataFrame:
    """word: the whole words of three lower-case letters or more that stand in at least two different texts."""
    words = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(r"(?<![\p{L}\p{N}+/_=-])\p{L}{3,}+(?![\p{N}+/_=])"), F.lit(0)))
    each = docs.filter("text IS NOT NULL").select(F.xxhash64("text").alias("h"), F.explode(words).alias("word"))
    return each.groupBy("word").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a < b").select("word")


def dictionary_of(docs: DataFrame, items: DataFrame) -> DataFrame:
    """word: the words of several documents, and all words of the items."""
    return common_words(docs).union(words_of(items)).distinct()


def entropy(value: Column) -> Column:
    """Bits a character."""
    n = F.greatest(F.length(value), F.lit(1))

    def add(total: Column, char: Column) -> Column:
        p = (n - F.length(F.replace(value, char, F.lit("")))) / n
        return total - F.when(p > 0, p * F.log2(p)).otherwise(0.0)

    return F.aggregate(F.array_distinct(F.split(value, "")), F.lit(0.0), add)


def candidates(docs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """A row per candidate with its features, and one with null value for each document without any."""
    # Values can only be in texts where a word for credentials is given something; others are searched for runs alone.
    given = F.col("text").rlike(f"(?i:{CREDENTIALS}){GIVEN}")
    found = written(spans.found(docs, {"secret": CANDIDATE, "run": RUN}, {"secret": given, "run": ~given & F.col("text").rlike("[A-Z0-9]")},
                                NEAR, across=True).drop("kind"), "found")
    value, before = F.col("value"), ascii_lower(F.coalesce("before", F.lit("")))
    n = F.greatest(F.length("value"), F.lit(1))
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / n
    found = found.withColumns({
        "length": F.length("value"), "digits": share("[0-9]"), "upper": share("[A-Z]"), "signs": share("[^A-Za-z0-9]"),
        "changes": F.regexp_count(value, F.lit("(?<=[0-9])(?=[^0-9])|(?<=[^0-9])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])")) / n,
        "distinct": F.size(F.array_distinct(F.split("value", ""))) / F.least(n, F.lit(64)),
        "entropy": entropy(F.left(value, F.lit(256))),
        "hex": value.rlike("^[0-9a-f]+$").cast("int"),
        "path": (value.rlike("/[^/]+/") | before.rlike(r"(?:://[^ ]*|[a-z]:?[/\\])$")).cast("int"),
        "shape": value.rlike(SHAPES).cast("int"),
        "name": (value.rlike("=$") & F.col("after").rlike("^[\"'`]") | F.col("after").rlike("^[\"'`]?[ \\t]*(?:=|:=|:[ \\t]*[\"'`])")).cast("int"),
        "quoted": before.rlike("[\"'`]$").cast("int"),
        "assigned": before.rlike(r"[=:]>?\s*[\"'`]?$").cast("int"),
        "credential": before.rlike(rf"(?:{CREDENTIALS})(?:{GIVEN}|[\"'`]?\s*(?:is)?\s*)[\"'`]?$").cast("int"),
    })
    # How much of a candidate lies in dictionary words: its letter runs are few, so they look the words up, not texts.
    runs = found.filter("value IS NOT NULL").select("value", F.explode(F.array_distinct(
        F.regexp_extract_all(ascii_lower(value), F.lit("[a-z]{3,}+"), F.lit(0)))).alias("word")).distinct()
    known = _small(written(runs.select("word").distinct().join(dictionary, "word"), "known"))
    covered = runs.join(known, "word").groupBy("value").agg((F.sum(F.length("word"))).alias("letters"))
    return found.join(covered, "value", "left").withColumn(
        "known", F.least(F.coalesce("letters", F.lit(0)) / F.greatest(F.length("value"), F.lit(1)), F.lit(1.0))).drop("letters")


def weak_labels(rows: DataFrame) -> DataFrame:
    """The rows with label 1, 0 or null."""
    named = (F.col("credential") == 1) & (F.col("assigned") == 1)
    number = (F.col("digits") == 1) & (F.col("length") < 6)
    random = (F.col("length") >= 20) & (F.col("entropy") >= 4.0) & (F.col("known") < 0.3) & (F.col("path") == 0) & F.col("value").rlike(
        "(?=.*[0-9])(?=.*[a-z])[^A-Z]*[A-Z]")
    yes = (F.col("name") == 0) & (named & (F.col("length") >= 4) & (F.col("known") < 0.5) & (F.col("distinct") > 0.1) & ~number | (F.col("shape") == 1) | random)
    words = (F.col("known") >= 0.5) & (F.col("digits") == 0)
    no = (F.col("name") == 1) | words | number | ((F.col("credential") == 0) & (F.col("assigned") == 0) & (
        (F.col("digits") == 1) | (F.col("path") == 1) | (F.col("known") >= 0.5)))
    return rows.withColumn("label", F.when(yes, 1.0).when(no, 0.0))


def findings(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """The candidates with score and secret, from a forest fitted on the labelled ones (features and label)."""
    known = labelled.filter("label IS NOT NULL")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    # A bounded draw of each class; weights give the classes their shares back.
    rates = {label: min(1.0, FIT_ROWS / 2 / n) for label, n in counts.items()}
    drawn = F.pmod(F.xxhash64("value", "doc_id", *FEATURES), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rate = F.coalesce(*[F.when(F.col("label") == label, F.lit(r)) for label, r in rates.items()], F.lit(1.0))
    some = written(known.withColumn("_rate", rate).filter(drawn < F.col("_rate")).withColumn("weight", 1 / F.col("_rate")), "drawn")
    left = {r["label"] for r in some.select("label").distinct().collect()}
    if len(left) < 2:
        score = F.lit(max(left or counts)) if counts else F.greatest(F.col("credential") * F.col("assigned"), F.col("shape"))
        return rows.withColumn("score", score.cast("double")).withColumn("secret", F.col("score") >= THRESHOLD)
    doubles = {c: F.col(c).cast("double") for c in FEATURES}
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt")
    model = forest.fit(assemble.transform(some.withColumns(doubles)).select("features", "label", "weight"))
    scored = model.transform(assemble.transform(rows.withColumns(doubles)))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction").withColumn(
        "secret", F.col("score") >= THRESHOLD)


def scan(docs: DataFrame, dictionary: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """A row per candidate: doc_id, text_hash, start, end, value, features, score, secret."""
    rows = written(candidates(docs, dictionary).filter("value IS NOT NULL"), "candidates")
    return findings(rows, weak_labels(rows) if labelled is None else labelled)


def clean(docs: DataFrame, dictionary: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The documents with every secret replaced by a mask; same rows, same columns."""
    found = scan(docs, dictionary, labelled).filter("secret")
    cuts = written(found.groupBy("doc_id", "text_hash").agg(F.collect_set("value").alias("values")).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("values").alias("_values")), "secrets")
    joined = docs.join(_small(cuts), docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_hash")), "left")
    gaps = joined.withColumns({
        "_gaps": F.when(F.col("_values").isNotNull(), F.split(docs["text"], CANDIDATE, -1)),
        "_runs": F.when(F.col("_values").isNotNull(), F.regexp_extract_all(docs["text"], F.lit(CANDIDATE), F.lit(0)))})
    masked = F.zip_with("_gaps", "_runs", lambda gap, run: F.concat(gap, F.when(run.isNull(), F.lit("")).when(
        F.array_contains("_values", run), F.lit(MASK)).otherwise(run)))
    text: Column = F.when(F.col("_values").isNull(), docs["text"]).otherwise(F.array_join(masked, ""))
    return gaps.select(*[text.alias(c) if c == "text" else docs[c] for c in docs.columns])
