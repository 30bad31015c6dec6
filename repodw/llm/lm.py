"""Language-model scores: a trigram model in Elias-Fano tries, one for each shard of contexts.

q(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)), p(w | u) = (c(u w) + K q(w)) / (c(u) + K) and
p(w | t u) = (c(t u w) + K_PAIR p(w | u)) / (c(t u) + K_PAIR): every order is smoothed by the next lower one (Dirichlet
priors). A document is its words and one end, after a start; its first word has the start alone as context.

1. Documents are packed into chunks: token numbers, the hashes of the chunk's distinct words, and their training counts.
2. Each chunk sends its words' counts to the shard of their hash, which adds them up, numbers the words that training
   knows, and sends number and total back. No table of all words is ever in one place.
3. Each chunk counts its distinct pairs and triples of known words before anything is sent, and sends them, nested, to the
   shard of their first word: a line that repeats a million times is sent once per chunk. First words with over `HOT`
   occurrences are dealt over several shards by the second word, triples of two such words by the third as well.
4. A shard adds up, builds its trie of quantised probabilities, finds every pair and triple in it (word, then its
   successors, then theirs) and sends their codes back; the chunk smooths and adds up by document.

Shards and chunks grow in number with the input, not in size; what moves are packed arrays. Nothing is capped or
sampled: each word, pair and triple of the training documents is counted. Codes are rounded down, and up where they count
a context, so that probabilities never sum to more than 1. They are smoothed when read, as the lower order of a triple lies
in another shard than the triple.

Nulls and odd input: a null or empty text is one end. A null doc_id is scored like any other, in the fold of an empty
id. Repeated rows give a row each and count each. With no training documents every token scores as an unknown word. An
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repodw.llm.hashing import lots, mixed
from repodw.llm.trie import Trie, quantised, restored
from repodw.session import written

CHUNK_TOKENS = 500_000
CHUNK_DOCS = 60_000
SHARD_WORDS = 1_000_000
SHARD_TOKENS = 1_500_000
HOT = 1_000_000
K = 40.0
K_PAIR = 4.0
END = np.uint64(0xE17D)
UNKNOWN, START = 0, 1
LOCAL = (1 << 32) - 1


def _pack(values: np.ndarray, dtype: str) -> bytes:
    """The numbers byte by byte of their width, all first bytes first, compressed."""
    raw = np.ascontiguousarray(values.astype(dtype))
    return zlib.compress(raw.view(np.uint8).reshape(-1, raw.itemsize).T.tobytes(), 1)


def _unpack(packed: bytes, dtype: str) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(packed), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def _bundle(*arrays: np.ndarray) -> bytes:
    """Numbers of at least 0, each array in as many bytes as its greatest one needs, compressed together."""
    head, planes = [], []
    for values in arrays:
        width = -(-int(values.max(initial=0)).bit_length() // 8)
        head += [len(values), width]
        planes.append(np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    return struct.pack("<" + "QB" * len(arrays), *head) + zlib.compress(b"".join(planes), 1)


def _unbundle(packed: bytes, many: int) -> list[np.ndarray]:
    form = "<" + "QB" * many
    head, raw = struct.unpack_from(form, packed), np.frombuffer(zlib.decompress(packed[struct.calcsize(form):]), np.uint8)
    out, at = [], 0
    for n, width in zip(head[::2], head[1::2]):
        values = np.zeros((n, 8), np.uint8)
        values[:, :width] = raw[at:at + n * width].reshape(width, n).T
        out.append(values.view("<i8").ravel())
        at += n * width
    return out


def _order(key: np.ndarray, many: int) -> np.ndarray:
    """Places of the numbers below `many` in rising order, equal ones as they come; few of them are sorted by digits."""
    return np.argsort(key.astype(np.uint16) if many <= 1 << 16 else key, kind="stable")


def _runs(rising: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins. numpy's unique hashes what is sorted already."""
    return np.flatnonzero(np.append(True, rising[1:] != rising[:-1])) if len(rising) else np.zeros(0, np.int64)


def _counted(rising: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers, and how often each comes."""
    begin = _runs(rising)
    return rising[begin], np.diff(np.append(begin, len(rising)))


def _by(key: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places) for the shards that occur in key."""
    order = _order(key, shards)
    begin = _runs(key[order])
    for lo, hi in zip(begin, np.append(begin[1:], len(order))):
        yield int(key[order[lo]]), order[lo:hi]


def chunks(docs: DataFrame) -> DataFrame:
    """Packed documents from rows (doc_id, text, train)."""

    def rows_of(ids: list, train: list, words: list[np.ndarray], number: int) -> dict:
        lengths = np.array([len(w) + 1 for w in words], np.uint32)
        tokens = np.concatenate([x for w in words for x in (w, [END])]).astype(np.uint64)
        vocabulary, token = np.unique(tokens, return_inverse=True)
        learned = np.repeat(np.array(train, bool), lengths)
        # Frequent words get small numbers, which pack better.
        counts = np.bincount(token, minlength=len(vocabulary))
        rank = np.empty(len(vocabulary), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(vocabulary))
        return {
            "chunk": number, "doc_id": ids, "train": np.array(train, np.uint8).tobytes(), "lengths": lengths.tobytes(),
            "tokens": _pack(rank[token], "<u4"), "rank": _pack(rank, "<u4"), "words": vocabulary.tobytes(),
            "counts": _pack(np.bincount(token[learned], minlength=len(vocabulary)), "<u4"), "n_words": len(vocabulary),
            "n_tokens": len(tokens)}

    id_type = pa.int64()
    schema = pa.schema([
        ("chunk", pa.int64()), ("doc_id", pa.list_(id_type)), ("train", pa.binary()), ("lengths", pa.binary()), ("tokens", pa.binary()),
        ("rank", pa.binary()), ("words", pa.binary()), ("counts", pa.binary()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, train, words, held = [], [], [], 0
        for batch in batches:
            doc_id, learned = batch.column("doc_id").to_pylist(), batch.column("train").to_pylist()
            for first, many, hashes, counts in lots(batch.column("text").to_pylist()):
                ends = np.cumsum(counts)
                for k in range(many):
                    ids.append(doc_id[first + k])
                    train.append(learned[first + k])
                    words.append(hashes[ends[k] - counts[k]:ends[k]])
                    held += int(counts[k]) + 1
                    if held >= CHUNK_TOKENS or len(ids) >= CHUNK_DOCS:
                        yield pa.RecordBatch.from_pylist([rows_of(ids, train, words, number)], schema)
                        ids, train, words, held, number = [], [], [], 0, number + 1
        if ids:
            yield pa.RecordBatch.from_pylist([rows_of(ids, train, words, number)], schema)

    sql = ("chunk long, doc_id array<long>, train binary, lengths binary, tokens binary, rank binary, words binary, "
           "counts binary, n_words long, n_tokens long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "train").mapInArrow(run, sql)


def numbered(packed: DataFrame, shards: int) -> DataFrame:
    """Per chunk and shard of its words: their numbers and training counts; and per shard, with a null chunk, how many
    words training knows and how many tokens it has. `shards` is a power of two."""
    shift = np.uint64(64 - (shards.bit_length() - 1))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, words, counts in zip(batch["chunk"], batch["words"], batch["counts"]):
                words, counts = np.frombuffer(words, np.uint64), _unpack(counts, "<u4")
                shard = (words >> shift).astype(np.int64) if shards > 1 else np.zeros(len(words), np.int64)
                # Words are sorted, so each shard has a stretch of them.
                yield pd.DataFrame([(s, chunk, words[at].tobytes(), _pack(counts[at], "<u4")) for s, at in _by(shard, shards)],
                                   columns=["shard", "chunk", "words", "counts"])

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        words = [np.frombuffer(w, np.uint64) for w in group["words"]]
        all_words, at = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(at, np.concatenate([_unpack(c, "<u4") for c in group["counts"]]), len(all_words)).astype(np.int64)
        known = total > 0
        # Frequent words get small numbers, which pack better.
        rank = np.empty(len(total), np.int64)
        rank[np.argsort(-total, kind="stable")] = np.arange(len(total))
        number = np.where(known, rank * shards + key[0] + 2, UNKNOWN)
        rows, first = [], 0
        for chunk, w in zip(group["chunk"], words):
            mine = at[first:first + len(w)]
            first += len(w)
            rows.append((key[0], chunk, _pack(number[mine], "<i8"), _pack(total[mine], "<i8"), 0, 0))
        rows.append((key[0], None, None, None, int(known.sum()), int(total.sum())))
        return pd.DataFrame(rows, columns=["shard", "chunk", "numbers", "totals", "v", "n"]).astype({"chunk": "Int64"})

    sent = packed.select("chunk", "words", "counts").mapInPandas(send, "shard int, chunk long, words binary, counts binary")
    return sent.groupBy("shard").applyInPandas(add, "shard int, chunk long, numbers binary, totals binary, v long, n long")


def _distinct(key: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys in order, the place of each row's key among them, and how often training has them."""
    keys, at = np.unique(key, return_inverse=True)
    return keys, at, np.bincount(at[learned], minlength=len(keys))


class Ngrams:
    """A chunk's tokens with their distinct pairs and triples of known words, the same each time it is made."""

    def __init__(self, row: dict, starts: int, shards: int):
        known = sorted(row["known"], key=lambda r: r["shard"])
        rank = _unpack(row["rank"], "<u4")
        number, total = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        number[rank] = np.concatenate([_unpack(r["numbers"], "<i8") for r in known])
        total[rank] = np.concatenate([_unpack(r["totals"], "<i8") for r in known])
        token = _unpack(row["tokens"], "<u4")
        self.lengths = np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
        first = np.cumsum(self.lengths) - self.lengths
        learned = np.repeat(np.frombuffer(row["train"], np.uint8) > 0, self.lengths)
        self.shards = shards
        # Places in the chunk's sorted numbers, in which unknown words are 0 and the start is 1.
        numbers, local = np.unique(np.append([UNKNOWN, START], number), return_inverse=True)
        size = np.zeros(len(numbers), np.int64)
        size[local[2:]], size[START] = total, starts
        word, self.count = local[2:][token], total[token]
        before = np.roll(word, 1)
        before[first] = START
        self.before = size[before]

        here = np.flatnonzero((word != UNKNOWN) & (before != UNKNOWN))
        keys, at, self.pair_count = _distinct(before[here] << 32 | word[here], learned[here])
        self.pair = np.full(len(word), -1)
        self.pair[here] = at
        a, b = keys >> 32, keys & LOCAL
        self.context = np.roll(self.pair, 1)
        self.context[first] = -1
        here = np.flatnonzero((word != UNKNOWN) & (self.context >= 0))
        keys, at, self.triple_count = _distinct(self.context[here] << 32 | word[here], learned[here])
        self.triple = np.full(len(word), -1)
        self.triple[here] = at
        self.parent, c = keys >> 32, keys & LOCAL
        self.first, self.second, self.third = numbers[a], numbers[b], numbers[c]

        place = lambda x: (mixed(x.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
        self.pair_shard = place(self.first * 64 + self.second % (size[a] // HOT + 1))
        salts = np.minimum(size[a], size[b])[self.parent] // HOT
        spread = mixed(self.first.astype(np.uint64))[self.parent] + self.second[self.parent].astype(np.uint64)
        self.triple_shard = np.where(salts > 0, place(mixed(spread) + (self.third % np.maximum(salts, 1)).astype(np.uint64)),
                                     self.pair_shard[self.parent])

    def parts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(shard, its pairs, how many of its triples follow each, its triples): pairs counted there or begun by a triple."""
        many = len(self.first)
        # Triples rise by their pair, so that by shard they rise by node, a shard's pair.
        order = _order(self.triple_shard, self.shards)
        wanted = (self.triple_shard * many + self.parent)[order]
        begin = _runs(wanted)
        nodes = np.sort(np.concatenate((self.pair_shard * many + np.arange(many), wanted[begin])))
        nodes = nodes[_runs(nodes)]
        follow = np.zeros(len(nodes), np.int64)
        follow[np.searchsorted(nodes, wanted[begin])] = np.diff(np.append(begin, len(wanted)))
        ends = np.append(0, np.cumsum(follow))
        shard = nodes // max(many, 1)
        bounds = _runs(shard)
        for lo, hi in zip(bounds, np.append(bounds[1:], len(shard))):
            yield int(shard[lo]), nodes[lo:hi] % many, follow[lo:hi], order[ends[lo]:ends[hi]]


FORM = "shard int, chunk long, payload binary"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _answers(group: pd.DataFrame, tokens: int) -> pd.DataFrame:
    """A shard's codes for the pairs and triples of each chunk."""
    parts = [_unbundle(payload, 7) for payload in group["payload"]]
    step, many, second, count, follow, third, count3 = range(7)
    a = np.concatenate([np.repeat(np.cumsum(p[step]), p[many]) for p in parts])
    b, c = (np.concatenate([p[k] for p in parts]) for k in (second, third))
    numbers, local = np.unique(np.concatenate((a, b, c)), return_inverse=True)
    a, b, c = np.split(local, np.cumsum((len(a), len(b))))
    sums = lambda at, k, n: np.bincount(at, np.concatenate([p[k] for p in parts]), n)
    pairs, pair_at = np.unique(a << 32 | b, return_inverse=True)
    pair_sum = sums(pair_at, count, len(pairs))
    parent = np.repeat(pair_at, np.concatenate([p[follow] for p in parts]))
    triples, triple_at = np.unique(parent << 32 | c, return_inverse=True)
    triple_sum = sums(triple_at, count3, len(triples))
    del a, b, c, local, parent
    # Training's alone, with the pairs that triples begin with.
    learned, asked = triple_sum > 0, np.bincount(triples >> 32, minlength=len(pairs))
    follows = np.bincount(triples[learned] >> 32, minlength=len(pairs))
    kept = (pair_sum > 0) | (follows > 0)
    if not kept.any():
        return pd.DataFrame([], columns=["shard", "chunk", "payload"])
    code = lambda x: np.where(x > 0, quantised(np.log10(np.maximum(x, 1) / tokens)), 0)
    first, seconds = _counted(numbers[pairs[kept] >> 32])
    trie = Trie(Trie.packed(first, (seconds, numbers[pairs[kept] & LOCAL], code(pair_sum[kept])),
                            (follows[kept], numbers[triples[learned] & LOCAL], code(triple_sum[learned]))))
    # What several chunks ask for is searched once.
    first, seconds = _counted(numbers[pairs >> 32])
    two, three = trie.codes(first, seconds, numbers[pairs & LOCAL], asked, numbers[triples & LOCAL])
    ends = np.cumsum([(len(p[second]), len(p[third])) for p in parts], axis=0)[:-1].T
    out = [(shard, chunk, _bundle(two[x], three[y])) for shard, chunk, x, y in zip(
        group["shard"], group["chunk"], np.split(pair_at, ends[0]), np.split(triple_at, ends[1]))]
    return pd.DataFrame(out, columns=["shard", "chunk", "payload"])


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score, score from rows (doc_id, text, train)."""
    packed = written(chunks(docs), "chunks")
    size = packed.agg(F.sum("n_words").alias("words"), F.sum("n_tokens").alias("tokens")).first()
    word_shards = 1 << max(0, ((size["words"] or 0) // SHARD_WORDS).bit_length())
    shards = max(1, -(-(size["tokens"] or 0) // SHARD_TOKENS))
    words = written(numbered(packed, word_shards), "words")
    facts = words.agg(F.sum("v").alias("v"), F.sum("n").alias("n")).first()
    n, v = facts["n"] or 0, facts["v"] or 0
    starts = docs.filter("train").count()
    total = n + 0.5 * (v + 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            grams, out = Ngrams(row, starts, shards), []
            for shard, pairs, follow, triples in grams.parts():
                begin = _runs(grams.first[pairs])
                first = grams.first[pairs[begin]]
                counted = np.where(grams.pair_shard[pairs] == shard, grams.pair_count[pairs], 0)
                out.append((shard, row["chunk"], _bundle(
                    np.diff(first, prepend=0), np.diff(np.append(begin, len(pairs))), grams.second[pairs], counted, follow,
                    grams.third[triples], grams.triple_count[triples])))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else ([], [], []), (
                pa.int32(), pa.int64(), pa.binary()))], names=["shard", "chunk", "payload"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            grams = Ngrams(row, starts, shards)
            found = {r["shard"]: r["payload"] for r in row["answers"] or []}
            two, three = np.zeros(len(grams.first), np.int64), np.zeros(len(grams.third), np.int64)
            for shard, pairs, _, triples in grams.parts():
                if shard in found:
                    codes, three[triples] = _unbundle(found[shard], 2)
                    mine = grams.pair_shard[pairs] == shard
                    two[pairs[mine]] = codes[mine]
            counts = lambda code, up=0: np.append(np.where(code > 0, n * 10 ** restored(code + up), 0), 0)
            base = (grams.count + 0.5) / total
            # A place of -1 reads the 0 at the end.
            p = (counts(two)[grams.pair] + K * base) / (grams.before + K)
            p = (counts(three)[grams.triple] + K_PAIR * p) / (counts(two, 1)[grams.context] + K_PAIR)
            doc = np.repeat(np.arange(len(grams.lengths)), grams.lengths)
            of_doc = lambda x: np.bincount(doc, x, len(grams.lengths))
            yield pa.RecordBatch.from_arrays([
                pa.array(row["doc_id"], pa.int64()), pa.array(np.frombuffer(row["train"], np.uint8) > 0), pa.array(grams.lengths),
                pa.array(of_doc(grams.count > 0).astype(np.int64)), pa.array(np.full(len(grams.lengths), n, np.int64)),
                pa.array(of_doc(np.log10(base))), pa.array(of_doc(np.log10(p)))],
                names=["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    known = words.filter("chunk IS NOT NULL").groupBy("chunk").agg(F.collect_list(F.struct("shard", "numbers", "totals")).alias("known"))
    # Read by both steps below; the second reuses what the first has shuffled.
    whole = packed.select("chunk", "doc_id", "train", "lengths", "tokens", "rank").join(known, "chunk")
    answers = whole.mapInArrow(send, FORM).groupBy("shard").applyInPandas(lambda group: _answers(group, n), FORM)
    answers = answers.groupBy("chunk").agg(F.collect_list(F.struct("shard", "payload")).alias("answers"))
    return whole.join(answers, "chunk", "left").mapInArrow(
        add_up, "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
