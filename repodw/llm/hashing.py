"""Hashes of words and word runs of many texts at once, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

# Bytes handled at a time: bounds the memory of a task, whatever the length of a text.
PIECE = 1 << 18
_K = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte (A-Z like a-z), blanks, and the powers of an odd number and of its inverse."""
    value = mixed(np.arange(1, 257, dtype=np.uint64) * _K)
    value[65:91] = value[97:123]
    blank = np.zeros(256, bool)
    blank[[32, *range(9, 14)]] = True
    powers = [np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(PIECE + 1, b, np.uint64))))
              for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return value, blank, *powers


def _sums_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, sum of value times power, and length of every word of at most PIECE bytes."""
    value, blank, power, inverse = _tables()
    inside = np.concatenate(([False], ~blank[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    upto = np.concatenate(([np.uint64(0)], np.cumsum(value[data] * power[:len(data)], dtype=np.uint64)))
    return start, (upto[end] - upto[start]) * inverse[start], end - start


def _hashes(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return mixed(sums + lengths.astype(np.uint64) * _K)


def _long(data: np.ndarray) -> np.ndarray:
    """Hash of every word of a text of any length: a word that goes on over the border of a piece is carried along."""
    blank, mask = _tables()[1], (1 << 64) - 1
    out, total, length = [], 0, 0
    for piece in _cuts(data):
        _, sums, lengths = _sums_of(piece)
        if length and not blank[piece[0]]:
            sums[0] = (total + int(sums[0]) * pow(_BASE, length, 1 << 64)) & mask
            lengths[0] += length
        elif length:
            out.append(_hashes(np.array([total], np.uint64), np.array([length])))
        total, length = 0, 0
        if not blank[piece[-1]]:
            total, length = int(sums[-1]), int(lengths[-1])
            sums, lengths = sums[:-1], lengths[:-1]
        out.append(_hashes(sums, lengths))
    if length:
        out.append(_hashes(np.array([total], np.uint64), np.array([length])))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _cuts(data: np.ndarray) -> Iterator[np.ndarray]:
    """Pieces that end after a blank; only a word of over PIECE bytes is itself cut, at PIECE."""
    blank, first = _tables()[1], 0
    while first < len(data):
        last = min(first + PIECE, len(data))
        if last < len(data):
            gaps = np.flatnonzero(blank[data[first:last]])
            last = first + int(gaps[-1]) + 1 if len(gaps) else last
        yield data[first:last]
        first = last


def lots(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, how many, hash of every word of these texts in order, number of words of each).

    Words are runs of non-blank characters, A-Z lower-cased; a lot holds texts of some PIECE bytes, or one longer text.
    """
    first, held, raw = 0, 0, []
    for n, text in enumerate(texts):
        one = (text or "").encode("utf-8", "surrogatepass")
        if raw and held + len(one) >= PIECE:
            yield first, len(raw), *_lot(raw)
            first, held, raw = n, 0, []
        raw.append(one)
        held += len(one) + 1
    if raw:
        yield first, len(raw), *_lot(raw)


def _lot(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    if len(raw) == 1:
        words = _long(np.frombuffer(raw[0], np.uint8))
        return words, np.array([len(words)])
    start, sums, lengths = _sums_of(np.frombuffer(b"\n".join(raw), np.uint8))
    words = _hashes(sums, lengths)
    ends = np.cumsum([len(one) + 1 for one in raw])
    return words, np.bincount(np.searchsorted(ends, start, side="right"), minlength=len(raw))


def shingles(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of `width` words within a text, and the number of runs of each text.

    A text of fewer words, but not none, has one run: all its words.
    """
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.repeat(np.cumsum(counts) - counts, runs) + np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    length = np.repeat(np.minimum(counts, width), runs)
    total = length.astype(np.uint64)
    for k in range(width):
        here = k < length
        total = np.where(here, mixed(total * _K + words[np.where(here, first + k, 0)]) if len(words) else total, total)
    return total, runs
