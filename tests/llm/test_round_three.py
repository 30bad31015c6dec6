"""Collocations, robust outliers and source divergence: brute force, pieces, borders of ranges, odd inputs."""
import math
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import DOCS, LOWER, ODD, REPEATED

from repodw.llm import collocate, divergence, hashing, langid, neardup, outliers, stages
from repodw.llm.queries import QUERIES


def _rows(texts, lang="en", source="a"):
    return [(k, t, lang, source, 1, "s", "l", 5) for k, t in enumerate(texts)]


def _pieces(text):
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def _phrases(rows):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        for words in _pieces(text):
            totals[lang or "und"] += len(words)
            for k in (1, 2, 3):
                counts[lang or "und"].update(tuple(words[s:s + k]) for s in range(len(words) - k + 1))
    return counts, totals


def _collocations(rows, least=10, best=2000):
    out, (counts, totals) = set(), _phrases(rows)
    for lang, f in counts.items():
        some = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in some.items():
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if not any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in some.items()):
                scored.append((-score, -a, " ".join(p).encode(), " ".join(p), f[p[:k]], f[p[k:]]))
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(scored)[:best], 1):
            out.add((lang, rank, phrase, -a, left, right, totals[lang], -score))
    return out


TALK = ["new york city is big. New York city, new york! x x x x x", "the old the new\tthe red the the", None, "",
        "a\x01 b a\x01 b\x00 c é ü é ü", "in new york city the mayor of new york city"] * 12


def test_collocations_equal_brute_force(spark, tables):
    rows = [*_rows(TALK), *_rows(TALK[:40], None), *_rows(TALK[:25], "und"), *REPEATED]
    found = {tuple(r) for r in QUERIES["op11_collocations"](spark, tables(documents=(rows, DOCS))).collect()}
    assert found == _collocations(rows) and len(found) > 40


def test_counts_of_a_text_cut_into_pieces(monkeypatch):
    """Pieces so small that every text is cut several times, within words and phrases."""
    texts = [*TALK[:6], " " * 90 + "one two" + " " * 90 + "three four", "w" * 200 + " a b c " + "v" * 100, "x " * 100, ". a . b . "]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array([t or "" for t in texts])], ["lang", "text"])
    expected, totals = _phrases([(0, t, "en") for t in texts])
    for size in (7, 16, 40, 1000):
        monkeypatch.setattr(collocate, "PIECE", size)
        found = Counter()
        everything = np.full(collocate.FILTER_BITS // 8, 255, np.uint8)
        for counted in (collocate._words_and_pairs, collocate._triples(everything)):
            for out in collocate._counter(counted)(iter([batch])):
                for phrase, n in zip(out["phrase"].to_pylist(), out["n"].to_pylist()):
                    found[tuple(phrase.split(" ")) if phrase else ()] += n
        assert found.pop(()) == totals["en"]
        assert +found == expected["en"], size


def test_phrases_over_borders_of_ranges(spark):
    """One word begins nearly all phrases, so that it is open in every range."""
    rows = [("en", f"hot w{k:03d}" + f" t{j}" * (j > 0), 1000 * (j == 0) + 10 + 7 * j + k, 2 + (j > 0), "hot", f"w{k:03d}", f"t{j}" if j else None)
            for k in range(60) for j in range(30)]
    rows += [("en", "hot", 99_999, 1, "hot", None, None), ("de", "hot", 5, 1, "hot", None, None), ("en", "zz", 3, 1, "zz", None, None)]
    stream = spark.createDataFrame(rows, "lang string, phrase string, n long, words int, w1 string, w2 string, w3 string")
    count = {(r[0], r[1]): r[2] for r in rows}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    try:
        found = collocate.with_heads(stream, [stream[c] for c in ("w1", "w2", "w3")], "test").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(found) == len(rows)
    for r in found:
        if r["words"] > 1:
            assert r["head1"] == count[r["lang"], r["w1"]]
        if r["words"] == 3:
            assert r["head2"] == count[r["lang"], f"{r['w1']} {r['w2']}"]
        if r["words"] == 2:
            assert r["longer"] == max(n for (lang, p), n in count.items() if lang == r["lang"] and p.startswith(r["phrase"] + " "))


def test_scores_stay_exact_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**14 + 7, 10**14 + 9, 10**14 + 8)], "n long, l long, r long")
    assert row.select(collocate._score("n", "l", "r")).first()[0] == 10**6 * (10**14 + 7) ** 2 // ((10**14 + 9) * (10**14 + 8))


def _divergence(rows, least, best=50):
    terms = [(lang or "", source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER)))) for _, t, lang, source, *_ in rows]
    out = set()
    for lang in {x[0] for x in terms}:
        spread, counts = Counter(), defaultdict(Counter)
        for mine, source, c in terms:
            if mine == lang:
                spread.update(c.keys())
                counts[source].update(c)
        kept = [t for t, n in spread.items() if n >= least]
        total = {s: sum(c[t] for t in kept) for s, c in counts.items()}
        share = lambda n, below: 1 + 10**9 * (n + 5) // (below + 5 * len(kept))
        p = {s: {t: share(c[t], total[s]) for t in kept} for s, c in counts.items()}
        q = {t: share(sum(c[t] for c in counts.values()), sum(total.values())) for t in kept}
        for s, c in counts.items():
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in counts if o != s]
            own = [(p[s][t] - q[t], t) for t in kept if c[t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", own, best)):
                for rank, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.add((lang, s, part, item, v, rank))
    return out


@pytest.mark.parametrize("least", [1, 3, 10**6])
def test_divergence_equals_brute_force(spark, tables, least):
    rows = [*REPEATED, *_rows(TALK, "en", "z"), *_rows(TALK[:9], "en", None), *_rows(["only here"], "xx", "one"), *_rows(["", None], "en", "void")]
    docs = spark.read.parquet(f"{tables(documents=(rows, DOCS))}/documents.parquet")
    assert {tuple(r) for r in divergence.audit(docs, least=least).collect()} == _divergence(rows, least)


def test_terms_of_a_long_text_in_pieces(monkeypatch):
    text = "Alpha beta " * 50 + "x" * 300 + " ünï " * 40 + "end"
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 3), pa.array(["a"] * 3), pa.array([text, "", "beta beta"])], ["lang", "source", "text"])
    whole = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER)))
    for size in (5, 64, 1 << 20):
        monkeypatch.setattr(divergence, "PIECE", size)
        counts, docs = Counter(), Counter()
        for out in divergence._partial_counts(iter([batch])):
            for r in out.to_pylist():
                counts[r["term"]] += r["n"]
                docs[r["term"]] += r["docs"]
        assert counts == whole + Counter({"beta": 2}) and docs == Counter([*whole, "beta"])


def test_shares_stay_exact_beyond_64_bits():
    for n, total, kept in ((10**14 + 3, 3 * 10**14 + 1, 10**9), (0, 0, 1), (7, 10, 3)):
        assert int(divergence.shares(np.array([n]), total, kept)[0]) == 1 + 10**9 * (n + 5) // (total + 5 * kept)


def _rules(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)), len(lines)


def test_rules_equal_brute_force(spark, tables):
    extra = _rows(["a b c a b c", "a a a a", "a a a", "a b", " \n\n x\nx\r\nx\n", "# $% <|> &*", "l\n\n l\nl\n" * 9, "w " * 60])
    rows = [*REPEATED, *extra]
    found = Counter((r[0], tuple(r)[1:6]) for r in QUERIES["op12_rules"](spark, tables(documents=(rows, DOCS))).collect())
    assert found == Counter((r[0], _rules(r[1])[0]) for r in rows)


def _mcd(x):
    """Plain concentration to the same objective from the same three starts, on exact order statistics by bins."""
    floor = np.diag(np.square(outliers.FLOORS))
    bins = lambda d: np.floor(8 * np.minimum(np.log2(np.maximum(d, 2.0 ** -10)), 40))

    def fit(y, factor):
        return y.mean(axis=0), factor * np.cov(y.T, bias=True) + floor

    def away(m, c):
        return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)

    median = np.array([sorted(np.round(col * 100) / 100)[(len(col) + 1) // 2 - 1] for col in x.T])
    m, c = fit(x, 1.0)
    ends = []
    for m, c in ((m, c), (median, c), (median, floor)):
        for _ in range(outliers.STEPS):
            b = bins(away(m, c))
            upto = sorted(b)[math.ceil(outliers.COVERED * len(b)) - 1]
            m, c = fit(x[b <= upto], outliers.NEAREST_FACTOR)
        ends.append((np.linalg.det(c), m, c))
    _, m, c = min(ends, key=lambda e: e[0])
    m, c = fit(x[away(m, c) <= outliers.NEAR], outliers.NEAR_FACTOR)
    return away(m, c)


def test_outliers_equal_a_plain_estimate_and_follow_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in QUERIES["op12_rules"](spark, folder).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert set(rows) == set(docs)
    pools = defaultdict(list)
    for i, d in docs.items():
        pools[d["lang"]].append(i)  # no source has a pool of its own here
    assert all(len(p) >= outliers.LEAST_POOL for p in pools.values())
    for ids in pools.values():
        x = []
        for i in ids:
            (n, chars, signs, dup, repeated), lines = _rules(docs[i]["text"])
            n = max(n, 1)
            x.append([math.log1p(_rules(docs[i]["text"])[0][0]), math.log(max(chars, 1) / n), math.sqrt(signs / max(chars, 1)), dup / max(lines, 1), repeated / n])
        expected = _mcd(np.floor(np.array(x) * outliers.UNIT + 0.5) / outliers.UNIT)
        assert [rows[i]["distance"] for i in ids] == pytest.approx(list(expected), rel=1e-5, abs=1e-6)
    judged = [(rows[i]["kept"], q) for i, q in labels.items() if not rows[i]["base_failed"]]
    good, bad = [k for k, q in judged if q == 1], [k for k, q in judged if q == 0]
    assert sum(good) / len(good) >= 0.99 and sum(bad) / len(bad) < 0.5


def test_a_source_of_its_own_and_hostile_majorities(spark, tables):
    """A pool with 20 % of shifted vectors: the estimate isn't drawn to them, all are rejected and the others kept."""
    words = [" ".join(f"word{(k * 7 + j * 13) % 997}" for j in range(80 + k % 60)) for k in range(400)]
    odd = [" ".join(f"<{(k + j) % 997}>$" for j in range(100 + k % 30)) for k in range(100)]
    rows = [(k, t, "en", "hot", 1, "s", "l", 5) for k, t in enumerate(words + odd)]
    rows += [(1000 + k, t, "en", f"s{k}", 1, "s", "l", 5) for k, t in enumerate(words[:50])]
    found = {r["doc_id"]: r["kept"] for r in QUERIES["op12_rules"](spark, tables(documents=(rows, DOCS))).collect()}
    assert not any(found[k] for k in range(400, 500)) and all(found[k] for k in [*range(400), *range(1000, 1050)])


@pytest.mark.parametrize("name", ["op11_collocations", "op12_rules", "op13_divergence"])
def test_empty_tables_and_odd_rows(spark, tables, name):
    assert QUERIES[name](spark, tables(documents=([], DOCS))).count() == 0


@pytest.mark.parametrize("name", ["op11_collocations", "op12_rules", "op13_divergence"])
def test_odd_rows(spark, tables, name):
    rows = QUERIES[name](spark, tables(documents=(REPEATED, DOCS))).collect()
    if name == "op12_rules":
        assert len(rows) == len(REPEATED) and not {r["doc_id"]: r["kept"] for r in rows}[ODD[0][0]]


def test_hashing_texts_takes_little_memory():
    """The tables and work arrays of a worker, which all its tasks share an executor with."""
    texts = ["some words of a text that goes on " * 60 + str(k) for k in range(4000)]
    hashing._tables.cache_clear()
    tracemalloc.start()
    found = sum(len(s) for _, s in neardup._sets(texts, 5))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    hashing._tables.cache_clear()
    assert found > 4000 and most < 40_000_000


def test_language_vectors_come_a_lot_at_a_time(monkeypatch):
    """Texts that are cut, and cut again, have the vectors they have whole, and no lot has those of all texts."""
    texts = ["der die das " * 9, "", "12 3", "x", "the cat and the dog " * 40, "und " * 3, "", "a b"] * 90
    whole = {first + k: (v, known) for first, vectors, lettered in langid.bundles(texts, 64) for k, (v, known) in enumerate(zip(vectors, lettered))}
    monkeypatch.setattr(langid, "PIECE", 50)
    cut = list(langid.bundles(texts, 64))
    assert len(cut) > 90 and max(len(vectors) for _, vectors, _ in cut) < 20
    again = {first + k: (v, known) for first, vectors, lettered in cut for k, (v, known) in enumerate(zip(vectors, lettered))}
    assert list(whole) == list(again) == list(range(len(texts)))
    assert all(whole[k][1] == again[k][1] == any(c.isalpha() for c in texts[k]) for k in whole)
    # A cut falls between words, but for the edge of the text that follows it.
    assert all((whole[k][0] == again[k][0]).all() for k in whole)


def test_pipeline_hands_python_small_batches(spark, monkeypatch):
    """Whole texts reach Python 2000 rows at a time, and the session's own size is back afterwards."""
    key, seen, rows = "spark.sql.execution.arrow.maxRecordsPerBatch", [], []

    def watched(of, name):
        inner = getattr(of, name)
        monkeypatch.setattr(of, name, lambda *a, **k: (seen.append((name, spark.conf.get(key))), inner(*a, **k))[1])

    watched(langid, "learn")
    watched(langid, "identify")
    watched(neardup, "near_duplicates")
    docs = spark.createDataFrame([(k, f"the words of text {k} " * 9, "en") for k in range(30)], "doc_id long, text string, lang string")
    before = spark.conf.get(key)
    for stage in (stages.identify_language, stages.drop_near_duplicates):
        rows.append(stage(spark, docs, "").count())
        assert spark.conf.get(key) == before
    assert seen == [("learn", "2000"), ("identify", "2000"), ("near_duplicates", "2000")] and rows[0] == 30
