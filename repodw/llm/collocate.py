"""Phrase collocations: count streams in prefix and in suffix order, merged in lockstep.

Phrases are counted per language: first words and pairs, then the triples whose two pairs may be frequent (a Bloom
filter of fixed size passes all that are and few others; a triple can't be more frequent than its pairs). Each task cuts
its texts into words, sorts the phrases of some megabytes as numbers and sends one row per distinct phrase.

The frequent phrases of all lengths form one stream. It is dealt into ranges and sorted by first, second and third word,
so every phrase directly follows what it begins with; one pass over a range gives each phrase the counts of its first
word and first pair, and each pair the greatest count of a triple that begins with it. The same pass over the stream
sorted by last, second last and third last word gives the counts of what a phrase ends with. A pass holds one word, one
pair and one batch; where a word's phrases reach over a border of ranges, what is open there is settled from one row
per range. So a word with any share of all phrases is spread like others, and nothing is joined by key.

A candidate is scored as floor(1000000 * a * a / (l * r)) with exact decimals; counts may reach 10^15.

Nulls and odd input: a null text is empty, a null language is `und` and counted together with a language of that
name; null and repeated ids don't matter, each row counts. Texts of any length are counted whole, in pieces that carry
the two words before them. Languages without candidates have no rows; an empty table gives an empty result. Further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repodw.llm import hashing
from repodw.llm.common import text_or_empty
from repodw.session import written

LEAST = 10
BEST = 2000
SHARE = 50
# Bytes of text counted in one go.
PIECE = 1 << 21
# Bits of the filter of frequent pairs: 16 MiB, whatever the size of the corpus.
FILTER_BITS = 1 << 27
_COUNTS = "lang string, phrase string, n long"

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _views(texts: pa.Array, rows: np.ndarray) -> list[memoryview]:
    """The bytes of some rows, not copied."""
    texts = texts.cast(pa.large_string())
    _, ends, data = texts.buffers()
    ends, data = np.frombuffer(ends, np.int64)[texts.offset:], memoryview(data or b"")
    return [data[ends[k]:ends[k + 1]] for k in rows]


def _pieces(texts: list[bytes | memoryview]) -> Iterator[tuple[np.ndarray, int]]:
    """The texts in stretches of about PIECE bytes, with how many words at the front were counted before.

    Only a single text longer than that is cut itself, after a blank or sign; its next stretch begins with the two words
    before the cut.
    """
    held, size = [], 0
    for text in texts:
        if size and size + len(text) > PIECE:
            yield _LOWER[np.frombuffer(b"\n".join(held), np.uint8)], 0
            held, size = [], 0
        if len(text) <= PIECE:
            held.append(text)
            size += len(text) + 1
        else:
            yield from _long(_LOWER[np.frombuffer(text, np.uint8)])
    if held:
        yield _LOWER[np.frombuffer(b"\n".join(held), np.uint8)], 0


def _long(data: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    first, before = 0, 0
    while first < len(data):
        last = min(first + PIECE, len(data))
        while last < len(data):
            gaps = np.flatnonzero(_KIND[data[first:last]])
            if len(gaps):
                last = first + int(gaps[-1]) + 1
                break
            last = min(last + PIECE, len(data))
        start, _ = _edges(data[before:first])
        carried = start[-2:]
        yield data[before + carried[0] if len(carried) else first:last], len(carried)
        # Far enough back to hold the last two words, or all that was carried.
        start, _ = _edges(data[first:last])
        before = first + int(start[-2]) if len(start) > 1 else (before + int(carried[0]) if len(carried) else first)
        first = last


def _edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words."""
    inside = np.concatenate(([False], _KIND[data] == 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


class _Words:
    """Words of a stretch as numbers of a vocabulary, and which of them follow the word before within a piece."""

    def __init__(self, data: np.ndarray):
        start, end = _edges(data)
        signs = np.concatenate(([0], np.cumsum(_KIND[data] == 2, dtype=np.int32)))
        self.follows = signs[start[1:]] == signs[end[:-1]]
        offsets = np.concatenate(([0], np.cumsum(end - start)))
        if offsets[-1] < 1 << 31:
            kind, offsets = pa.StringArray, offsets.astype(np.int32)
        else:
            kind = pa.LargeStringArray
        words = kind.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[_KIND[data] == 0]))
        coded = words.dictionary_encode()
        self.vocabulary, self.ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)

    def phrases(self, *codes: np.ndarray) -> pa.Array:
        taken = [self.vocabulary.take(pa.array(c)) for c in codes]
        return taken[0] if len(taken) == 1 else pc.binary_join_element_wise(*taken, " ")

    def hashes(self) -> np.ndarray:
        """Of the vocabulary; its words hold no blank, so that they are told apart again."""
        lots = hashing.lots([b"\n".join(self.vocabulary.cast(pa.binary()).to_pylist()).decode("utf-8", "surrogateescape")])
        return np.concatenate([words for _, _, words, _ in lots] or [np.zeros(0, np.uint64)])


def _words_and_pairs(words: _Words, carried: int, _lang: str) -> Iterator[tuple[pa.Array, np.ndarray]]:
    ids, size = words.ids, len(words.vocabulary)
    counts = np.bincount(ids[carried:], minlength=size)
    some = np.flatnonzero(counts)
    yield pa.array([""]), np.array([len(ids) - carried])
    yield words.phrases(some), counts[some]
    fresh = words.follows & (np.arange(1, len(ids)) >= carried)
    codes, counts = np.unique((ids[:-1] * size + ids[1:])[fresh], return_counts=True)
    yield words.phrases(codes // max(size, 1), codes % max(size, 1)), counts


def _places(first: np.ndarray, second: np.ndarray, lang: str) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the filter for each pair of word hashes."""
    salt = np.uint64(next(hashing.lots([lang.encode().hex() + "."]))[2][0])
    mixed = hashing.mixed(hashing.mixed(first + salt) * np.uint64(0x9E3779B97F4A7C15) + second)
    return mixed % np.uint64(FILTER_BITS), (mixed >> np.uint64(32)) % np.uint64(FILTER_BITS)


def _triples(bits: np.ndarray):
    def counted(words: _Words, carried: int, lang: str) -> Iterator[tuple[pa.Array, np.ndarray]]:
        ids, size = words.ids, len(words.vocabulary)
        hashes = words.hashes()[ids]
        known = words.follows.copy()
        for place in _places(hashes[:-1], hashes[1:], lang):
            known &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        at = np.flatnonzero(known[:-1] & known[1:])
        at = at[at + 2 >= carried]
        pairs, pair = np.unique(ids[at] * size + ids[at + 1], return_inverse=True)
        codes, counts = np.unique(pair * size + ids[at + 2], return_counts=True)
        pair = pairs[codes // max(size, 1)] if len(codes) else codes
        yield words.phrases(pair // max(size, 1), pair % max(size, 1), codes % max(size, 1)), counts

    return counted


def _counter(counted):
    """A function for mapInArrow: counts of phrases by language, of some PIECE bytes of text each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch["lang"].dictionary_encode()
            number = langs.indices.to_numpy()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                for data, carried in _pieces(_views(batch["text"], np.flatnonzero(number == k))):
                    for phrases, counts in counted(_Words(data), carried, lang):
                        yield pa.RecordBatch.from_arrays(
                            [pa.repeat(lang, len(counts)), phrases.cast(pa.string()), pa.array(counts, pa.int64())], ["lang", "phrase", "n"])

    return run


def _summed(counts: DataFrame, least: int) -> DataFrame:
    return counts.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter((F.col("n") >= least) | (F.col("phrase") == ""))


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, phrase, n of all phrases of one to three words found `least` times or more, and the number of a
    language's words under the empty phrase."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty(F.col("text")).alias("text"))
    short = written(_summed(texts.mapInArrow(_counter(_words_and_pairs), _COUNTS), least), "pairs")
    bits = docs.sparkSession.sparkContext.broadcast(_filter(short.filter(F.col("phrase").contains(" "))))

    def triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counter(_triples(bits.value))(batches)

    long = written(_summed(texts.mapInArrow(triples, _COUNTS), least), "triples")
    bits.unpersist()
    return short.unionByName(long)


def _filter(pairs: DataFrame) -> np.ndarray:
    """The filter's bits as bytes. Tasks set bits, words of 64 bits are merged before they reach the driver, which
    gets FILTER_BITS / 64 of them at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch["lang"].to_pylist(), object)
            words = _Words(np.frombuffer(b"\n".join(batch["phrase"].cast(pa.binary()).to_pylist()), np.uint8))
            hashes = words.hashes()[words.ids] if len(words.ids) else np.zeros(0, np.uint64)
            for lang in set(langs):
                mine = langs == lang
                places = np.unique(np.concatenate(_places(hashes[::2][mine], hashes[1::2][mine], lang)))
                slots, first = np.unique(places >> np.uint64(6), return_index=True)
                values = np.bitwise_or.reduceat(np.uint64(1) << (places & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64)), pa.array(values.view(np.int64))], ["slot", "bits"])

    merged = pairs.select("lang", "phrase").mapInArrow(run, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    found = merged.toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[found["slot"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint8)


class _Lockstep:
    """One pass over a sorted range of the stream."""

    def __init__(self) -> None:
        self.word = self.pair = -1  # counts of what is open, -1 where it began in an earlier range
        self.held: pa.RecordBatch | None = None  # the open pair, which waits for its triples
        self.held_most = 0
        self.front = 0  # greatest triple before any head of this range
        self.headed = False

    def step(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        if self.held is not None:
            batch = pa.concat_batches([self.held, batch])
        n, words = batch["n"].to_numpy(), batch["words"].to_numpy()
        place = np.arange(len(n))
        of_word = np.maximum.accumulate(np.where(words == 1, place, -1))
        head = np.maximum.accumulate(np.where(words < 3, place, -1))
        word = np.where(of_word >= 0, n[of_word], self.word)
        pair = np.where(head >= 0, n[head], self.pair)
        most = np.zeros(len(n), np.int64)
        if self.held is not None:
            most[0] = self.held_most
        triples = words == 3
        under = triples & (head >= 0)
        np.maximum.at(most, head[under], n[under])
        self.front = max(self.front, int(n[triples & (head < 0)].max(initial=0)))
        self.word = int(word[-1])
        out = _with(batch, word, np.where(triples, pair, 0), np.where(words == 2, most, 0), False)
        last = int(head[-1])
        if last < 0:
            return out
        self.headed = True
        self.held = None
        self.pair = 0
        if words[last] == 2:
            self.held, self.held_most, self.pair = batch.slice(last, 1), int(most[last]), int(n[last])
            out = pa.concat_batches([out.slice(0, last), out.slice(last + 1)])
        return out

    def end(self) -> pa.RecordBatch | None:
        if self.held is None:
            return None
        return _with(self.held, np.array([self.word]), np.array([0]), np.array([self.held_most]), True)


def _with(batch: pa.RecordBatch, word: np.ndarray, pair: np.ndarray, most: np.ndarray, open_end: bool) -> pa.RecordBatch:
    part = TaskContext.get().partitionId()
    more = {"head1": pa.array(word, pa.int64()), "head2": pa.array(pair, pa.int64()), "longer": pa.array(most, pa.int64()),
            "part": pa.repeat(pa.scalar(part, pa.int32()), len(word)), "edge": pa.repeat(open_end, len(word)),
            "front": pa.nulls(len(word), pa.int64()), "headed": pa.nulls(len(word), pa.bool_())}
    return pa.RecordBatch.from_arrays([*batch.columns, *more.values()], [*batch.schema.names, *more])


def with_heads(stream: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The stream (with columns n, and words: how many of them), sorted by language and `order`, with head1 and head2, the
    counts of the first word and pair in that order, and longer, the greatest count of a triple on a pair."""
    columns = stream.columns
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in stream.schema.fields]
                       + ["head1 long", "head2 long", "longer long", "part int", "edge boolean", "front long", "headed boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, shape = _Lockstep(), None
        for batch in batches:
            shape = batch.schema
            if batch.num_rows:
                yield state.step(batch)
        if shape is None:
            return
        if (last := state.end()) is not None:
            yield last
        # One row for the range itself: what is open at its end, and the greatest triple at its front.
        blank = pa.RecordBatch.from_arrays([pa.nulls(1, f.type) for f in shape], shape.names)
        row = _with(blank, np.array([state.word]), np.array([state.pair]), np.array([0]), False)
        row = row.set_column(row.schema.get_field_index("front"), "front", pa.array([state.front], pa.int64()))
        yield row.set_column(row.schema.get_field_index("headed"), "headed", pa.array([state.headed]))

    keys = [F.col("lang"), *order]
    merged = written(stream.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema), name)
    # A row per range, and so no more than there are tasks.
    ranges = merged.filter(F.col("front").isNotNull()).select("part", "head1", "head2", "front", "headed").orderBy("part").collect()
    settled, word, pair = [], -1, -1
    for k, r in enumerate(ranges):
        ahead = 0
        for later in ranges[k + 1:]:
            ahead = max(ahead, later["front"])
            if later["headed"]:
                break
        settled.append((r["part"], word, pair, ahead))
        word = r["head1"] if r["head1"] >= 0 else word
        pair = r["head2"] if r["headed"] else pair
    carry = stream.sparkSession.createDataFrame(settled, "part int, open1 long, open2 long, ahead long")
    rows = merged.filter(F.col("front").isNull()).join(F.broadcast(carry), "part")
    return rows.select(
        *columns, F.when(F.col("head1") < 0, F.col("open1")).otherwise(F.col("head1")).alias("head1"),
        F.when(F.col("head2") < 0, F.col("open2")).otherwise(F.col("head2")).alias("head2"),
        F.when(F.col("edge"), F.greatest("longer", "ahead")).otherwise(F.col("longer")).alias("longer"))


def _score(a: str, left: str, right: str) -> Column:
    """Exact: a decimal's integral division."""
    a, left, right = (f"CAST({c} AS DECIMAL(15, 0))" for c in (a, left, right))
    return F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * {a} * {a}) DIV ({left} * {right})")


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST, share: int = SHARE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `best` phrases of two or three words found `least` times
    or more, less those of which a longer candidate makes up `share` percent."""
    counts = frequent_phrases(docs, least)
    sizes = counts.filter(F.col("phrase") == "").select("lang", F.col("n").alias("total"))
    word = F.split("phrase", " ", -1)
    stream = counts.filter(F.col("phrase") != "").select(
        "lang", "phrase", "n", F.size(word).alias("words"), *[F.get(word, F.lit(k)).alias(f"w{k + 1}") for k in range(3)])
    by_front = with_heads(stream, [F.col("w1"), F.col("w2"), F.col("w3")], "prefix").withColumnsRenamed(
        {"head1": "front1", "head2": "front2", "longer": "onward"})
    back = [F.element_at(F.split("phrase", " ", -1), -1).alias("w1")] + [
        F.try_element_at(F.split("phrase", " ", -1), F.lit(-k)).alias(f"w{k}") for k in (2, 3)]
    turned = by_front.select("lang", "phrase", "n", "words", *back, "front1", "front2", "onward")
    both = with_heads(turned, [F.col("w1"), F.col("w2"), F.col("w3")], "suffix")
    scored = both.filter("words > 1").withColumns({
        "s1": F.when(F.col("words") == 2, _score("n", "front1", "head1")).otherwise(_score("n", "front1", "head2")),
        "s2": F.when(F.col("words") == 3, _score("n", "front2", "head1"))})
    late = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    dropped = (F.col("words") == 2) & (100 * F.greatest("onward", "longer") >= share * F.col("n"))
    rows = scored.filter(~dropped).select(
        "lang", "phrase", F.col("n").alias("a"), F.when(late, F.col("front2")).otherwise(F.col("front1")).alias("l"),
        F.when((F.col("words") == 3) & ~late, F.col("head2")).otherwise(F.col("head1")).alias("r"),
        F.when(late, F.col("s2")).otherwise(F.col("s1")).alias("score"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
