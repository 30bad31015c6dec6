"""The compact levels against plain search, and what a repeated line sends."""
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from repodw.llm import lm
from repodw.llm.trie import EliasFano, Trie, quantised


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (1, 10**12), (5, 3), (1000, 50), (1000, 10**9), (70_000, 10**6), (70_000, 2**40)])
def test_levels_are_searched_as_sorted_numbers(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n))
    level = EliasFano(memoryview(EliasFano.packed(values)))
    assert (level[np.arange(n)] == values).all()
    asked = np.concatenate((rng.integers(0, top + 5, 2000), values))
    assert (level.successor(asked) == np.searchsorted(values, asked)).all()
    assert ((level.find(asked) >= 0) == np.isin(asked, values)).all()
    # No more than two bits and the low ones for each, and the counts of blocks.
    assert level.end * 8 <= n * (level.width + 4) * 1.2 + 2000


def test_trie_finds_its_pairs_and_triples_alone():
    rng = np.random.default_rng(2)
    triples = sorted({tuple(map(int, t)) for t in rng.integers(2, 60, (4000, 3))})
    pairs = sorted({t[:2] for t in triples[::2]} | {(70, 5), (71, 2)})
    triples = [t for t in triples if t[:2] in set(pairs)]
    first = Counter(p[0] for p in pairs)
    follow = Counter(t[:2] for t in triples)
    code2, code3 = np.arange(1, len(pairs) + 1), np.arange(1, len(triples) + 1)
    trie = Trie(Trie.packed(np.array(sorted(first)), (np.array([first[k] for k in sorted(first)]), np.array([p[1] for p in pairs]), code2),
                            (np.array([follow[p] for p in pairs]), np.array([t[2] for t in triples]), code3)))
    words = np.arange(75)
    asked = [(a, b) for a in words for b in words]
    two, three = trie.codes(words, np.full(75, 75), np.tile(words, 75), np.full(75 * 75, 75), np.tile(words, 75 * 75))
    known = dict(zip(pairs, code2))
    assert two.tolist() == [known.get(p, 0) for p in asked]
    known = dict(zip(triples, code3))
    assert three.tolist() == [known.get((a, b, c), 0) for a, b in asked for c in words]


def test_codes_round_down():
    p = np.array([1e-13, 0.3, 1.0])
    assert (quantised(np.log10(p)) > 0).all()


def test_bundles_keep_every_number():
    arrays = [np.array([], np.int64), np.array([0, 0]), np.array([255, 256, 2**40]), np.array([7])]
    for a, b in zip(arrays, lm._unbundle(lm._bundle(*arrays), 4)):
        assert (a == b).all() and len(a) == len(b)


def test_hot_words_dealt_over_shards_give_the_same_scores(spark, monkeypatch):
    """One line 20,000 times and some others, over many shards with every word hot, against one shard with none."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 5 != 1).alias("train"), F.when(
        F.col("id") < 19_000, "to be or not to be that is to be").otherwise(F.concat(F.lit("to be "), F.col("id") % 97, F.lit(" or "), F.col("id") % 31)).alias("text"))

    def scored():
        return {r["doc_id"]: r["score"] for r in lm.scores(docs).collect()}

    once = scored()
    monkeypatch.setattr(lm, "HOT", 50)
    monkeypatch.setattr(lm, "SHARD_TOKENS", 20_000)
    dealt = scored()
    assert len(once) == 20_000 and dealt == pytest.approx(once, abs=1e-9)


def test_a_repeated_line_is_sent_once():
    """Pairs and triples are counted before anything is sent, so what is sent doesn't grow with repeats."""

    def sent(times):
        words = np.tile(np.arange(2, 12), times)
        row = {"known": [{"shard": 0, "numbers": lm._pack(np.arange(2, 12), "<i8"), "totals": lm._pack(np.full(10, times), "<i8")}],
               "rank": lm._pack(np.arange(10), "<u4"), "tokens": lm._pack(words - 2, "<u4"),
               "lengths": np.full(times, 10, np.uint32).tobytes(), "train": np.ones(times, np.uint8).tobytes()}
        grams = lm.Ngrams(row, times, 3)
        assert set(grams.pair_count) == set(grams.triple_count) == {times}
        return sum(len(pairs) + len(triples) for _, pairs, _, triples in grams.parts())

    assert sent(1) == sent(100_000) == 19


def test_ngrams_are_dealt_without_hashing_what_is_sorted(monkeypatch):
    """parts() gives each shard its pairs, those its triples begin with among them, and its triples in order; numpy's unique
    without places, which hashes, took most of its time."""
    draw = np.random.default_rng(3)
    words, lengths = draw.permutation(60), np.array([4000, 1, 999], np.uint32)
    total = np.where(words < 3, 3 * lm.HOT, words)
    row = {"known": [{"shard": 0, "numbers": lm._pack(np.where(words > 50, lm.UNKNOWN, words + 2), "<i8"), "totals": lm._pack(total, "<i8")}],
           "rank": lm._pack(np.arange(60), "<u4"), "tokens": lm._pack(draw.integers(0, 60, lengths.sum()), "<u4"),
           "lengths": lengths.tobytes(), "train": np.array([1, 0, 1], np.uint8).tobytes()}
    grams = lm.Ngrams(row, 2, 7)
    plain = {}
    for k, s in enumerate(grams.pair_shard):
        plain.setdefault(int(s), {})[k] = []
    for k, (s, pair) in enumerate(zip(grams.triple_shard, grams.parent)):
        plain.setdefault(int(s), {}).setdefault(int(pair), []).append(k)
    monkeypatch.setattr(lm.np, "unique", lambda *a, **k: pytest.fail("unique"))
    found = {s: (pairs.tolist(), follow.tolist(), triples.tolist()) for s, pairs, follow, triples in grams.parts()}
    assert len(found) == 7 and (grams.triple_shard != grams.pair_shard[grams.parent]).any()
    assert list(found) == sorted(plain)
    for s, of_shard in plain.items():
        pairs = sorted(of_shard)
        assert found[s] == (pairs, [len(of_shard[k]) for k in pairs], [t for k in pairs for t in of_shard[k]])
    assert [(s, at.tolist()) for s, at in lm._by(np.array([2, 0, 2, 5]), 8)] == [(0, [1]), (2, [0, 2]), (5, [3])]
    assert not list(lm._by(np.zeros(0, np.int64), 8))


def test_no_ngrams():
    """Documents without words, of a training that knows not even their end."""
    row = {"known": [{"shard": 0, "numbers": lm._pack(np.zeros(1), "<i8"), "totals": lm._pack(np.zeros(1), "<i8")}],
           "rank": lm._pack(np.zeros(1), "<u4"), "tokens": lm._pack(np.zeros(2), "<u4"), "lengths": np.array([1, 1], np.uint32).tobytes(),
           "train": np.zeros(2, np.uint8).tobytes()}
    assert not list(lm.Ngrams(row, 0, 3).parts())
