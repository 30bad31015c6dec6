"""One query per operator, over its whole tables, and equivalent SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repodw.llm import chat, collocate, decontaminate, divergence, langid, lm, merkle, mix, neardup, outliers, pii, quality, secrets
from repodw.llm.common import fold, table
from repodw.session import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents hold passages of which benchmark items."""
    found = decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        "contaminated")


ORACLES["op1_decontaminate"] = r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
i AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS length, array_to_string(words[s:s + least(len(words), 10) - 1], ' ') AS w
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS s FROM i WHERE len(words) > 0)),
probes AS (
    SELECT doc_id, length, s, array_to_string(words[s:s + length - 1], ' ') AS w
    FROM (SELECT doc_id, words, length, unnest(range(1, len(words) - length + 2)) AS s
          FROM w, (SELECT DISTINCT length FROM item_windows) WHERE len(words) >= length)),
found AS (SELECT doc_id, s, length, item_id FROM probes JOIN item_windows USING (length, w)),
positions AS (SELECT doc_id, count(DISTINCT p) AS n_hit
              FROM (SELECT doc_id, unnest(range(s, s + length)) AS p FROM found) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
           FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN positions USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


@query
def op2_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document the mix takes, and the shards it puts them into."""
    docs = written(mix.placed(table(spark, folder, "documents")), "placed")
    return mix.takings(docs).select(
        "doc_id", "size", "source_size", "target", "taken", "source", F.array_join(F.transform("shards", lambda s: s.cast("string")), ",").alias("shards"))


@query
def op6_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    rows = merkle.edited(table(spark, folder, "documents"))
    for text, name in (("text", "fingerprint"), ("edited", "edited_fingerprint"), ("next", "next_fingerprint")):
        rows = merkle.with_fingerprint(rows, text, name)
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        merkle.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        merkle.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


@query
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every document, learned from the labels of four of five folds."""
    labels = table(spark, folder, "labels").filter(fold(F.col("doc_id")) != 0).select("doc_id", F.col("quality").alias("label"))
    found = quality.score_documents(table(spark, folder, "documents"), labels)
    return found.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


@query
def op4_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of every document by a language model learned from four of five folds."""
    docs = table(spark, folder, "documents").select("doc_id", "text", (fold(F.col("doc_id")) != 1).alias("train"))
    return lm.scores(docs).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Every candidate for a secret in every document, and whether it is one."""
    docs = table(spark, folder, "documents")
    found = secrets.scan(docs, secrets.dictionary_of(docs, table(spark, folder, "benchmark")))
    return found.select("doc_id", "start", "end", F.sha2("value", 256).alias("value_sha256"), "score", "secret")


def _tree(text: str) -> str:
    pieces = r"'(?:[^ ]*[^ .!?] +){0,11}[^ ]+ *| +'"
    line = f"array_to_string(list_transform(regexp_extract_all(line, {pieces}), lambda p: md5(p)[1:16]), ',')"
    lines = f"list_transform(list_transform(string_split({text}, chr(10)), lambda line: {line}), lambda h: md5(h)[1:16] || ':' || h)"
    sections = f"regexp_extract_all(array_to_string({lines}, '|'), '(?:[2-9a-f][^|]*\\|){{0,31}}[^|]+\\|?')"
    return f"array_to_string(list_transform({sections}, lambda s: md5(s)[1:16] || '=' || rtrim(s, '|')), ';')"


def _root(body: str, text: str) -> str:
    return f"CASE WHEN {text} = '' THEN sha256('') ELSE sha256({body}) || ';' || {body} END"


def _near(a: str, b: str) -> str:
    x, y = (f"list_distinct(regexp_extract_all({f}, '[:,]([0-9a-f]{{16}})', 1))" for f in (a, b))
    return (f"CASE WHEN {a}[1:64] = {b}[1:64] THEN CAST(1 AS DOUBLE) WHEN len({x}) + len({y}) = 0 THEN CAST(0 AS DOUBLE) "
            f"ELSE CAST(2 * len(list_intersect({x}, {y})) AS DOUBLE) / (len({x}) + len({y})) END")


ORACLES["op6_merkle"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, text) AS k FROM documents),
pairs AS (SELECT a.doc_id, a.text, b.text AS next, length(a.text) AS n
          FROM d a JOIN d b ON b.k = (CASE WHEN a.k = (SELECT max(k) FROM d) THEN 1 ELSE a.k + 1 END)),
e AS (SELECT *, substr(text, 1, n - n // 3) || substr(next, 1, n // 3) AS edited FROM pairs),
t AS (SELECT *, {_tree("text")} AS a, {_tree("edited")} AS b, {_tree("next")} AS c FROM e),
f AS (SELECT *, {_root("a", "text")} AS fingerprint, {_root("b", "edited")} AS edited_fingerprint,
             {_root("c", "next")} AS next_fingerprint FROM t)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
       {_near("fingerprint", "edited_fingerprint")} AS near_edited, {_near("fingerprint", "next_fingerprint")} AS near_next
FROM f
"""


@query
def op7_chat(spark: SparkSession, folder: str) -> DataFrame:
    """What is read back from the formatted text of every conversation, and of one that says the template's own markers."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    spoken = "\\### Assistant: </turn> ok"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(spoken).alias("text"))
    read = chat.read_back(chat.formatted(chat.turns_of(chat.conversation_records(rows.unionByName(own)))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"))


ORACLES["op7_chat"] = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
written AS (
    SELECT *, replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t') AS t,
           replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), chr(10), '\n') AS r FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ' || r || chr(10) || t || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id
"""


@query
def op8_neardup(spark: SparkSession, folder: str) -> DataFrame:
    """The group of near-duplicates of every document, on sets of 4-word shingles."""
    return neardup.near_duplicates(table(spark, folder, "documents"), width=4)


@query
def op9_langid(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from four of five folds."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", (fold(F.col("doc_id")) == 0).alias("held_out"))
    model = langid.learn(docs.filter(~F.col("held_out")))
    return langid.identify(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def _of_kind(number: int) -> Callable[[Column], Column]:
    return lambda span: span["k"] == number


@query
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """The personal data of every document."""
    rows = pii.report(table(spark, folder, "documents"))
    counts = {f"n_{kind}": F.size(F.filter("base", _of_kind(k))).cast("long") for k, kind in enumerate(pii.KINDS, 1)}
    return rows.select("doc_id", *[c.alias(n) for n, c in counts.items()], F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
                       pii.listed(F.col("spans")).alias("spans"))


@query
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The strongest phrases of every language."""
    return collocate.collocations(table(spark, folder, "documents"))


ORACLES["op11_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
f AS (
    SELECT lang, k, array_to_string(words[s:s + k - 1], ' ') AS phrase, count(*) AS a
    FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS s FROM w, (VALUES (1), (2), (3)) t(k) WHERE len(words) >= k)
    GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE k > 1 AND a >= 10),
cuts AS (
    SELECT c.lang, c.phrase, c.a, c.k, j, x.a AS l, y.a AS r,
           (CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.a AS HUGEINT) * y.a) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
    JOIN f x ON x.lang = c.lang AND x.k = j AND x.phrase = array_to_string(words[1:j], ' ')
    JOIN f y ON y.lang = c.lang AND y.k = c.k - j AND y.phrase = array_to_string(words[j + 1:], ' ')),
cut AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_pairs AS (
    SELECT lang, array_to_string(words[1:2], ' ') AS phrase, a FROM c WHERE k = 3
    UNION ALL SELECT lang, array_to_string(words[2:3], ' '), a FROM c WHERE k = 3),
covered AS (SELECT lang, phrase, max(a) AS most FROM inner_pairs GROUP BY ALL),
kept AS (SELECT cut.* FROM cut LEFT JOIN covered USING (lang, phrase) WHERE k = 3 OR 100 * coalesce(most, 0) < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


@query
def op12_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The counts of every document, whether it fails the base rules, and whether it is kept."""
    return outliers.judged(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


@query
def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """How far the sources of every language are apart, and the terms that tell each from its language."""
    return divergence.audit(table(spark, folder, "documents"))


ORACLES["op13_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (
    SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
v AS (SELECT lang, count(*) AS kept FROM kept GROUP BY lang),
p AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (g.total + 5 * v.kept) AS p
    FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
whole AS (
    SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (sum(n) + 5)) // (any_value(total) + 5 * any_value(kept)) AS q
    FROM p JOIN (SELECT lang, sum(total) AS total FROM g GROUP BY lang) USING (lang) JOIN v USING (lang) GROUP BY lang, term),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
    FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
    LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN p y ON y.lang = a.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
found AS (
    SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value FROM pairs
    UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 50
"""
