"""Every query on the smallest tables: against its SQL, and against plain Python where SQL can't say it."""
import hashlib
import math
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from brute import blank_words, fold, near_components

from repodw.llm import pii
from repodw.llm.lm import K, K_PAIR
from repodw.llm.mix import targets
from repodw.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted(map(tuple, cursor.fetchall()), key=repr)


def test_mix_meets_targets_and_repeats(spark, docs):
    rows = QUERIES["op2_mix"](spark, FOLDER).collect()
    assert sorted(rows, key=repr) == sorted(QUERIES["op2_mix"](spark, FOLDER).collect(), key=repr)
    sizes = {i: len([w for w in re.split(r"[\x20\x09-\x0D]+", d["text"] or "") if w]) for i, d in docs.items()}
    assert {r["doc_id"]: r["size"] for r in rows} == sizes
    taken, found = Counter(), {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        found[r["source"]] = (r["source_size"], r["target"])
    names = sorted(found, key=lambda s: (s is None, (s or "").encode()))
    assert [found[s][1] for s in names] == targets([found[s][0] for s in names])
    for s in names:
        assert abs(taken[s] - found[s][1]) <= 1


def test_quality_tells_labels_apart(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op3_quality"](spark, "/root/testdata/sf0.01").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(rows[i]["predicted"], q) for i, q in labels.items() if rows[i]["held_out"]]
    assert len(held) > 50 and sum(p == q for p, q in held) / len(held) > 0.93
    assert all(r["held_out"] == (fold(i) == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for i, r in rows.items())


def test_lm_scores_are_the_models(spark, docs):
    rows = QUERIES["op4_lm"](spark, FOLDER).collect()
    tokens = {i: [*blank_words(d["text"]), None] for i, d in docs.items()}
    train = [i for i in tokens if fold(i) != 1]
    count = Counter(w for i in train for w in tokens[i])
    pairs = Counter(p for i in train for p in zip([0, *tokens[i]], tokens[i]))
    triples = Counter(p for i in train for p in zip([0, *tokens[i]], tokens[i], tokens[i][1:]))
    total, context = sum(count.values()), Counter({**count, 0: len(train)})
    q = lambda w: (count[w] + 0.5) / (total + 0.5 * (len(count) + 1))
    held, base = 0.0, 0.0
    assert len(rows) == len(tokens)
    for r in rows:
        mine = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(mine), sum(w in count for w in mine), total)
        assert r["base_score"] == pytest.approx(sum(math.log10(q(w)) for w in mine))
        exact = 0.0
        for k, w in enumerate(mine):
            t, u = [0, 0, *mine][k], [0, *mine][k]
            p = (pairs[u, w] + K * q(w)) / (context[u] + K)
            exact += math.log10((triples[t, u, w] + K_PAIR * p) / (pairs[t, u] + K_PAIR) if k else p)
        assert exact - 0.001 * len(mine) - 1e-9 <= r["score"] <= exact + 0.001 * len(mine)
        if r["held_out"]:
            held, base = held + r["score"], base + r["base_score"]
    assert held > base


def test_secrets_are_found_and_others_left(spark, docs):
    rows = QUERIES["op5_secrets"](spark, "/root/testdata/sf0.01").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    expected = {(i, m.start(1), m.end(1)) for i, t in texts.items() for m in re.finditer('token = "([0-9a-f]{40})"', t)}
    found = {(r["doc_id"], r["start"], r["end"]) for r in rows if r["secret"]}
    assert expected and expected <= found
    assert all(not texts[i][a:b].isdigit() for i, a, b in found)


def test_near_duplicates_equal_brute_force(spark, docs):
    rows = QUERIES["op8_neardup"](spark, FOLDER).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == near_components(
        [(i, d["text"]) for i, d in docs.items()], 4)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_languages_on_held_out_documents(spark):
    rows = QUERIES["op9_langid"](spark, "/root/testdata/sf0.01").collect()
    known = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(known) and all(r["held_out"] == (fold(r["doc_id"]) == 0) for r in rows)
    assert sum(r["lang_pred"] == known[r["doc_id"]] for r in held) / len(held) > 0.97


def _base_spans(text):
    def luhn(digits):
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
        return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0

    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = defaultdict(list)
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]:
                out[kind].append(f"{kind}:{m.start()}:{m.end()}")
    return out


@pytest.mark.parametrize("copies", [1, 3])
@pytest.mark.parametrize("odd", [False, True])
def test_personal_data_equals_plain_patterns(spark, docs, tables, odd, copies):
    texts = {i: d["text"] for i, d in docs.items()}
    if odd:
        texts = dict(enumerate([
            "a@b.c_d@e.f x@y.z.", "1.2.3.4.5.6.7.8 999.1.1.1 0255.01.2.3", "+1+1 (234) 555-1234 +12", "", None,
            "4111 1111 1111 1111 4111-1111-1111-1112", "é😀 a@b.co 1.1.1.1", "1" * 20_000 + " " + "1 " * 9_000,
            "a" * 20_000 + "@b.c" + "x." * 9_000 + "@q.r", "call (212) 555-1234 or joe [at] example [dot] com"]))
    folder = tables(documents=(list(texts.items()) * copies, "doc_id long, text string")) if odd or copies > 1 else FOLDER
    found = QUERIES["op10_pii"](spark, folder).collect()
    assert len(found) == len(texts)
    rows = {r["doc_id"]: r for r in found}
    assert set(rows) == set(texts)
    for i, text in texts.items():
        base = _base_spans(text)
        listed = [s for kind in pii.KINDS for s in base[kind]]
        assert [rows[i][f"n_{kind}"] for kind in pii.KINDS] == [len(base[kind]) for kind in pii.KINDS]
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(rows[i]["spans"].split(",")) | {""}
