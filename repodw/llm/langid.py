"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +-1; a trigram's vector binds those of its letters, permuted by their place, by
elementwise product; a text's vector bundles (sums) the vectors of all its trigrams; a language's prototype bundles the
vectors of all texts labelled with it. A text gets the language whose prototype has the greatest cosine with it.
Letters are drawn from a generator seeded by code point, so that any task, at any time, draws the same ones.

Prototypes are summed by partition and language before they are shuffled; the model is one vector per language.

Nulls and odd input: a text that is null or has no letter is `und` with score 0; so is every text if nothing was
learned. A null language is not learned from. Ties go to the language that sorts first. Repeated rows give a row each.
An empty table gives an empty result. Texts are read whole, in pieces of bounded size; further columns pass through
`identify` untouched unless named lang_pred or score, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

UNKNOWN = "und"
DIMENSIONS = 1024
# Characters handled at a time: bounds the memory of a task, whatever the length of a text.
PIECE = 1_000_000
# Trigrams whose vectors are held at a time.
BLOCK = 4096


@cache
def letter(code: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng((7, code)).choice(np.array([-1.0, 1.0], np.float32), dimensions)


@cache
def letters() -> np.ndarray:
    """Per code point its lower-case letter, or 0 for what is no letter."""
    return np.fromiter((ord(chr(c).lower()[0]) if chr(c).isalpha() else 0 for c in range(0x110000)), np.int64, 0x110000)


def trigram_vectors(keys: np.ndarray, dimensions: int) -> np.ndarray:
    """A row per key, whose three fields of 21 bits are code points (0: an edge of a word)."""
    out = None
    for place, shift in enumerate((42, 21, 0)):
        codes, at = np.unique((keys >> shift) & 0x1FFFFF, return_inverse=True)
        part = np.stack([np.roll(letter(int(c), dimensions), place) for c in codes])[at]
        out = part if out is None else np.multiply(out, part, out=out)
    return out


def ranked(values: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and the place of each value among them; all are below top."""
    if top > 1 << 23:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(top, bool)
    seen[values] = True
    distinct = np.flatnonzero(seen)
    place = np.zeros(top, np.int64)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[values]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams of the texts' letters, with an edge before and after each word; per trigram found, the text it
    is in and its place among the distinct ones."""
    raw = "\n".join(texts).encode("utf-32-le", "surrogatepass")
    codes = letters()[np.frombuffer(raw, np.uint32)]
    text = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])[:len(codes)]
    alphabet, code = ranked(np.concatenate(([0], codes, [0])), 0x110000)
    size = len(alphabet)
    keys = (code[:-2] * size + code[1:-1]) * size + code[2:]
    inside = codes > 0
    distinct, at = ranked(keys[inside], size ** 3)
    full = (alphabet[distinct // size ** 2] << 42) | (alphabet[distinct // size % size] << 21) | alphabet[distinct % size]
    return full, text[inside], at


def pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """The texts in lots of at most some PIECE characters, with their places; a longer text is cut between words."""
    places, lot, held = [], [], 0
    for place, text in enumerate(texts):
        start = 0
        while start < len(text) or start == 0:
            end = start + PIECE
            while end < len(text) and text[end - 1].isalpha() and end < start + 2 * PIECE:
                end += 1
            places.append(place)
            lot.append(text[start:end])
            held += len(lot[-1])
            if held >= PIECE or len(lot) >= 512:
                yield places, lot
                places, lot, held = [], [], 0
            start = end
    if lot:
        yield places, lot


def bundles(texts: list[str], dimensions: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The vectors of the texts, counts times trigram vectors, and whether each has a letter, a lot at a time behind the
    place of its first text. The last text of a lot, which may go on in the next one, is held back for that."""
    base, held, known = 0, np.zeros((0, dimensions), np.float32), np.zeros(0, bool)
    for places, lot in pieces(texts):
        at_lot = np.array(places) - base
        out, lettered = np.zeros((at_lot[-1] + 1, dimensions), np.float32), np.zeros(at_lot[-1] + 1, bool)
        out[:len(held)], lettered[:len(known)] = held, known
        keys, text, at = trigrams(lot)
        lettered[at_lot[np.unique(text)]] = True
        for first in range(0, len(keys), BLOCK):
            many = min(BLOCK, len(keys) - first)
            here = (at >= first) & (at < first + many) if len(keys) > BLOCK else slice(None)
            counts = np.bincount(text[here] * many + at[here] - first, minlength=len(lot) * many).astype(np.float32)
            vectors = counts.reshape(len(lot), many) @ trigram_vectors(keys[first:first + many], dimensions)
            np.add.at(out, at_lot, vectors)
        if len(out) > 1:
            yield base, out[:-1], lettered[:-1]
        base, held, known = places[-1], out[-1:].copy(), lettered[-1:]
    if len(held):
        yield base, held, known


def learn(docs: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototype of each language, of unit length, from rows (text, lang)."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, group in batch.groupby("lang"):
                for _, lot in pieces(group["text"].tolist()):
                    keys, _, at = trigrams(lot)
                    counts = np.bincount(at, minlength=len(keys)).astype(float)
                    for part in range(0, len(keys), BLOCK):
                        vectors = trigram_vectors(keys[part:part + BLOCK], dimensions)
                        sums[lang] = sums.get(lang, 0) + counts[part:part + BLOCK] @ vectors
        if sums:
            yield pd.DataFrame({"lang": list(sums), "total": [v.tolist() for v in sums.values()]})

    known = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", F.col("lang").cast("string").alias("lang"))
    sums = known.mapInPandas(partial, "lang string, total array<double>")
    per_place = sums.select("lang", F.posexplode("total").alias("place", "value")).groupBy("lang", "place").agg(F.sum("value").alias("value"))
    # One vector a language: as many rows as there are languages, however many documents.
    vectors = per_place.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("v"))
    model = {}
    for row in vectors.select("lang", "v.value").collect():
        vector = np.array(row["value"])
        if (length := np.linalg.norm(vector)) > 0:
            model[row["lang"]] = vector / length
    return model


def identify(docs: DataFrame, model: dict[str, np.ndarray], dimensions: int = DIMENSIONS) -> DataFrame:
    """The rows with lang_pred and score, the cosine with that language's prototype (0 where negative)."""
    langs = sorted(model)
    prototypes = np.stack([model[name] for name in langs]).astype(np.float32) if langs else None
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [UNKNOWN] * len(batch), np.zeros(len(batch))
            if prototypes is not None:
                for first, vectors, lettered in bundles([t or "" for t in batch.column("text").to_pylist()], dimensions):
                    lengths = np.linalg.norm(vectors, axis=1)
                    cosines = vectors @ prototypes.T / np.where(lengths > 0, lengths, 1)[:, None]
                    last = first + len(vectors)
                    names[first:last] = [langs[k] if known else UNKNOWN for k, known in zip(cosines.argmax(1), lettered)]
                    scores[first:last] = np.where(lettered, np.clip(cosines.max(1), 0, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(names, pa.string()), pa.array(scores)], names=[*kept, "lang_pred", "score"])

    # Arrow batches as they are, so that other columns pass through unchanged.
    return docs.mapInArrow(predict, StructType([
        *[docs.schema[c] for c in kept], StructField("lang_pred", StringType()), StructField("score", DoubleType())]))
