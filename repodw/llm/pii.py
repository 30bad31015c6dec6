"""Personal data by weak supervision.

Candidates are the spans of exact patterns (the base) and of looser ones. Labelers, each a regular expression, a
checksum, a word list or a look at the neighbourhood, vote +1 (personal), -1 (not) or 0 on every candidate. Expectation
maximisation over the counts of vote patterns estimates how often each labeler votes and is right in either class, and
from that each candidate's probability of being personal; with these as weights a logistic regression is trained on
features of the span, and decides on the looser candidates. Base spans always stay; a match of a base pattern that fails
its check (Luhn, range, digits) is evidence for the labelers, but never becomes a span.

The counts of vote patterns cover all documents; there are at most 3^5 of them, whatever the size of the input. The
regression is fitted on at most `FIT_ROWS` candidates, drawn by hash.

Nulls and odd input: a null or empty text has no spans. Rows that repeat doc_id and text are one document. Where all
candidates are taken to be of one class, nothing is added. An empty table gives an empty result; further columns are
ignored. Patterns use possessive groups, which need no stack, so texts and matches may be of any length.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repodw.llm import spans
from repodw.session import written

# The kinds in their order, and their base patterns.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser forms: an address written out, a number with trunk zero or area code in brackets.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++ ?[\[(]dot[\])] ?[A-Za-z]{2,}+",
    "phone": r"(?<![0-9+(-])(?<!\+[0-9]{1,3}[ .-])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9-])",
}
# Word lists of the labelers.
CUES = {
    "email": "mail|email|contact|write|reply|from|to", "ip": "ip|host|server|address|login|from",
    "card": "card|visa|credit|debit|mastercard|payment", "phone": "phone|tel|telephone|call|mobile|fax|dial",
}
TOP_LEVELS = "com|org|net|edu|gov|io|de|fr|es|uk|eu|info|biz|ch|at|it|nl|us"
LABELERS = ("strict", "gazetteer", "context", "embedded", "length")
SURE = 0.9
FIT_ROWS = 50_000
ROUNDS = 50


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn's sum is a multiple of 10; for at most 19 digits."""
    places = F.sequence(F.lit(1), F.length(digits))
    each = F.transform(places, lambda k: F.substring(F.reverse(digits), k, F.lit(1)).cast("int") * F.when(k % 2 == 0, 2).otherwise(1))
    return F.aggregate(each, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    """Whether a match of a base pattern is a base span."""
    digits = _digits(value)
    ip = value.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$")
    card = F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    return (F.when(kind == "email", True).when(kind == "ip", ip).when(kind == "card", card)
            .when(kind == "phone", F.length(digits).between(8, 15)).otherwise(False))


def candidates(docs: DataFrame) -> DataFrame:
    """A row per candidate: doc_id, text_hash, kind, start, end, value, before, after, base, loose; null kind: a document without."""
    text = F.col("text")
    screens = {
        "email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9][ -]?[0-9]"), "phone": text.contains("+"),
        "loose_email": text.contains("at]") | text.contains("at)"), "loose_phone": text.rlike(r"[0-9]{3}[-.][0-9]{4}"),
    }
    rows = spans.found(docs, BASE | {f"loose_{k}": p for k, p in LOOSE.items()}, screens)
    loose = F.coalesce(F.col("kind").startswith("loose_"), F.lit(False))
    return rows.withColumns({"loose": loose, "base": ~loose & _valid(F.col("kind"), F.col("value"))}).withColumn(
        "kind", F.regexp_replace("kind", "^loose_", ""))


def votes(rows: DataFrame) -> DataFrame:
    """The rows with a column per labeler."""
    value, before, after, digits = F.col("value"), F.lower("before"), F.col("after"), _digits(F.col("value"))

    def by_kind(**of_kind: Column) -> Column:
        out = F.lit(0)
        for kind, vote in of_kind.items():
            out = F.when(F.col("kind") == kind, vote).otherwise(out)
        return out

    sign = lambda yes, no=-1: F.when(yes, 1).otherwise(no)
    known = by_kind(
        email=sign(F.lower(value).rlike(rf"(?:\.|dot[\])] ?)(?:{TOP_LEVELS})$")), ip=sign(~value.rlike(r"^(?:0|255)\.")),
        card=sign(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)"), 0), phone=sign(digits.rlike("^(?:1|2|3|4|5|6|7|8|9)[0-9]+$")))
    cued = by_kind(**{k: sign(before.rlike(rf"\b(?:{words})\b[^a-z0-9]*$"), 0) for k, words in CUES.items()})
    length = by_kind(
        email=sign(F.length("value").between(6, 254)), ip=sign(F.length("value").between(7, 15)),
        card=sign(F.length(digits).between(16, 19)), phone=sign(F.length(digits).between(8, 15)))
    inside = before.rlike(r"[a-z0-9]$") | after.rlike("^[A-Za-z0-9]")
    return rows.withColumns({
        "strict": sign(F.col("base")), "gazetteer": known, "context": cued, "embedded": F.when(inside, -1).otherwise(0), "length": length})


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """The probability of being personal of each pattern of votes, by expectation maximisation over their counts."""
    if not patterns:
        return {}
    labelers = range(len(patterns[0][0]))
    odds = {p: min(max(0.5 + 0.45 * sum(p) / max(1, sum(map(abs, p))), 0.05), 0.95) for p, _ in patterns}
    for _ in range(rounds):
        mass = {c: 1.0 + sum(n * (odds[p] if c else 1 - odds[p]) for p, n in patterns) for c in (0, 1)}
        # Chance of each vote of each labeler in either class; a labeler is taken to be right more often than not.
        says = {(k, v, c): (0.5 + (1.0 if v == 2 * c - 1 else 0.0) + sum(n * (odds[p] if c else 1 - odds[p]) for p, n in patterns if p[k] == v))
                / (mass[c] + 2.5) for k in labelers for v in (-1, 0, 1) for c in (0, 1)}
        new = {}
        for p, _n in patterns:
            a, b = (math.log(mass[c]) + sum(math.log(says[k, p[k], c]) for k in labelers) for c in (1, 0))
            new[p] = 1 / (1 + math.exp(min(max(b - a, -50), 50)))
        odds = new
    return odds


def personal(docs: DataFrame) -> DataFrame:
    """All candidates with their score, base spans having 1, and a row with null kind for each document without any:
    doc_id, text_hash, kind, start, end, value, base, score."""
    spark = docs.sparkSession
    voted = written(votes(candidates(docs)), "candidates")
    counted = voted.filter("kind IS NOT NULL").groupBy(*LABELERS).agg(F.count("*").alias("n")).collect()
    odds = reliabilities(sorted((tuple(r[k] for k in LABELERS), r["n"]) for r in counted))
    table = spark.createDataFrame([(*p, float(o)) for p, o in odds.items()], ", ".join(f"{k} int" for k in LABELERS) + ", odds double")
    rows = voted.join(F.broadcast(table), list(LABELERS), "left").withColumn("score", F.when(F.col("base"), 1.0))
    kept = ["doc_id", "text_hash", "kind", "start", "end", "value", "base"]
    unsure = rows.filter("loose AND NOT base")
    sure = rows.filter("kind IS NULL OR base OR NOT loose").select(*kept, F.coalesce("score", F.lit(0.0)).alias("score"))
    if not odds or max(odds.values()) < 0.5 or min(odds.values()) >= 0.5:
        return sure.unionByName(unsure.select(*kept, F.lit(0.0).alias("score")))
    total = sum(r["n"] for r in counted)
    features = [F.col("kind") == k for k in KINDS] + [
        F.length("value") / 20.0, F.length(_digits(F.col("value"))) / 20.0, F.size(F.array_distinct(F.split("value", ""))) / 20.0,
        F.col("strict"), F.col("gazetteer"), F.col("context"), F.col("embedded"), F.col("length")]
    named = {f"f{k}": f.cast("double") for k, f in enumerate(features)}
    assemble = VectorAssembler(inputCols=list(named), outputCol="features", handleInvalid="keep")
    some = rows.filter("kind IS NOT NULL").filter(
        F.pmod(F.xxhash64("doc_id", "kind", "start"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, FIT_ROWS / total)))
    weighted = some.withColumn("c", F.explode(F.array(F.lit(0.0), F.lit(1.0)))).withColumn(
        "w", F.when(F.col("c") == 1, F.col("odds")).otherwise(1 - F.col("odds")))
    model = LogisticRegression(featuresCol="features", labelCol="c", weightCol="w", regParam=0.01, maxIter=25).fit(
        assemble.transform(weighted.withColumns(named)).select("features", "c", "w"))
    scored = model.transform(assemble.transform(unsure.withColumns(named)))
    return sure.unionByName(scored.select(*kept, vector_to_array("probability")[1].alias("score")))


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, text_hash, base and spans (arrays of struct(k, start, end) in order, k the kind's number).

    A span that the method adds and that overlaps a base span of its document is left out.
    """
    order = F.when(F.col("kind").isNotNull(), F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int"))
    span = F.struct(order.alias("k"), "start", "end")
    grouped = personal(docs).groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.when(F.col("base"), span))).alias("base"),
        F.collect_set(F.when(~F.col("base") & (F.col("score") >= SURE), span)).alias("more"))
    apart = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return grouped.select("doc_id", "text_hash", "base", F.array_sort(F.array_union("base", apart)).alias("spans"))


def listed(spans_of: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans_of, lambda s: F.concat_ws(":", F.get(names, s["k"] - 1), s["start"], s["end"])), ",")
