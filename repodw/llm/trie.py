"""An n-gram trie in a few flat buffers: Elias-Fano coded words, pointers and successors, quantised probabilities.

A level of monotone numbers is held as Elias-Fano does: the low bits of each side by side, the high bits as a bit vector
in which number i sets bit (high + i), with the ones before every 64 bits counted once. It is searched as it lies: a
query counts bits in the words it touches, nothing is unpacked first.

The first level is the sorted words that begin an n-gram. Every further level holds the successors of the nodes of the
level above: a pointer says where those of a node begin, and they are made monotone by adding the greatest value so far at
each new node. All is one bytes object of which readers map views.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np

# Steps of a decade, and the least exponent, of a quantised probability. Code 0 stands for none.
STEPS, LEAST = 2000, -16.0
# Queries worked on at a time.
SLICE = 1 << 15


def quantised(log10: np.ndarray) -> np.ndarray:
    """In 16 bits, rounded down."""
    return np.clip(np.floor((log10 - LEAST) * STEPS), 1, 65535).astype(np.uint16)


def restored(code: np.ndarray) -> np.ndarray:
    return code / STEPS + LEAST


class EliasFano:
    """A sorted sequence of numbers of at least 0, fewer than 2^30 of them."""

    def __init__(self, buffer: memoryview):
        self.n, self.width, self.top, low, high = struct.unpack_from("<QQqQQ", buffer)
        views, at = [], 40
        for dtype, many in ((np.uint64, low), (np.uint64, high), (np.uint32, high)):
            views.append(np.frombuffer(buffer, dtype, many, at))
            at += views[-1].nbytes
        self.low, self.high, self.ones = views
        self.end = at

    @staticmethod
    def packed(values: np.ndarray) -> bytes:
        values = values.astype(np.uint64)
        n, last = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (last // max(n, 1)).bit_length() - 1)
        high = (values >> np.uint64(width)).astype(np.int64)
        bits = np.zeros(-(-((int(high[-1]) if n else 0) + n + 1) // 128) * 128, np.uint8)
        bits[high + np.arange(n)] = 1
        high_words = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.cumsum(np.bitwise_count(high_words), dtype=np.uint32) - np.bitwise_count(high_words)
        # As many bits of each as wanted; slices of a multiple of eight numbers end at whole bytes.
        low = b"".join(np.packbits(np.unpackbits(
            values[k:k + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :width].ravel(), bitorder="little").tobytes()
            for k in range(0, n, SLICE)) if width else b""
        low += bytes(-len(low) % 8 + 8)
        head = struct.pack("<QQqQQ", n, width, int(high[-1]) if n else -1, len(low) // 8, len(high_words))
        return head + low + high_words.tobytes() + ones.astype(np.uint32).tobytes()

    def _select(self, rank: np.ndarray, zero: bool) -> np.ndarray:
        """Place of the bit with this number among the ones, or among the zeros, of the high bits."""
        before = np.uint32(64) * np.arange(len(self.ones), dtype=np.uint32) - self.ones if zero else self.ones
        out = np.empty(len(rank), np.int64)
        for first in range(0, len(rank), SLICE):
            left = rank[first:first + SLICE].astype(np.uint32)
            place = np.searchsorted(before, left, side="right") - 1
            left, word = (left - before[place]).astype(np.uint8), self.high[place]
            word, place = ~word if zero else word, place * 64
            for half in (32, 16, 8, 4, 2, 1):
                many = np.bitwise_count(word & np.uint64((1 << half) - 1))
                above = many <= left
                left -= many * above
                step = above * np.uint64(half)
                place += step.astype(np.int64)
                word = word >> step
            out[first:first + SLICE] = place
        return out

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(at), np.int64)
        bit = at * self.width
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        over = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (((self.low[word] >> shift) | over) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def _below(self, high: np.ndarray) -> np.ndarray:
        """How many numbers have a smaller high part."""
        return np.where(high > 0, self._select(np.maximum(high - 1, 0), True) - (high - 1), 0)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return ((self._select(at, False) - at) << self.width) | self._low(at)

    def _near(self, value: np.ndarray, begin: np.ndarray | int, end: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first number of at least `value` in the places from begin to end, and where those end that share
        its high part: by the high part, then by halving the stretch of numbers that share it."""
        high = np.minimum(value >> self.width, self.top + 1)
        lo = np.maximum(self._below(high), begin)
        last = np.maximum(np.minimum(self._below(np.minimum(high + 1, self.top + 1)), end), lo)
        want, hi = value & ((1 << self.width) - 1), last.copy()
        open_ = np.flatnonzero(lo < hi) if self.width else np.zeros(0, np.int64)
        while len(open_):
            middle = (lo[open_] + hi[open_]) // 2
            less = self._low(middle) < want[open_]
            lo[open_] = np.where(less, middle + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], middle)
            open_ = open_[lo[open_] < hi[open_]]
        return lo, last

    def successor(self, value: np.ndarray) -> np.ndarray:
        """Place of the first number of at least `value`."""
        return self._near(value, 0, self.n)[0]

    def find(self, value: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> np.ndarray:
        """Place of each number in the places from begin to end, or -1."""
        at, last = self._near(value, begin, self.n if end is None else end)
        inside = np.flatnonzero(at < last)
        hit = inside[self._low(at[inside]) == (value[inside] & ((1 << self.width) - 1))]
        out = np.full(len(value), -1)
        out[hit] = at[hit]
        return out


def _joined(parts: list[bytes]) -> bytes:
    """Each with its length before it, at multiples of eight bytes."""
    return b"".join(struct.pack("<Q", len(p)) + p + bytes(-len(p) % 8) for p in parts)


def _parted(view: memoryview) -> Iterator[memoryview]:
    while len(view):
        (size,) = struct.unpack_from("<Q", view)
        yield view[8:8 + size]
        view = view[8 + size + -size % 8:]


class Level:
    """The successors of each node of the level above."""

    def __init__(self, pointers: memoryview, base: memoryview, values: memoryview, codes: memoryview):
        self.pointers, self.base, self.values = EliasFano(pointers), EliasFano(base), EliasFano(values)
        self.codes = np.frombuffer(codes, np.uint16)

    @staticmethod
    def packed(many: np.ndarray, value: np.ndarray, code: np.ndarray) -> list[bytes]:
        """From the number of successors of each node above, and these in rising order node by node."""
        pointers = np.append(0, np.cumsum(many))
        greatest = np.zeros(len(many), np.int64)
        greatest[many > 0] = value[pointers[1:][many > 0] - 1]
        base = np.cumsum(greatest) - greatest
        return [*map(EliasFano.packed, (pointers, base, value + np.repeat(base, many))), code.astype(np.uint16).tobytes()]

    def find(self, above: np.ndarray, many: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Place of each value, `many` of them in turn among the successors of each node `above`, or -1; a node of -1 has none."""
        nodes = np.flatnonzero(above >= 0)
        begin, end = self.pointers[above[nodes]], self.pointers[above[nodes] + 1]
        # Only nodes that are in here and have successors are searched.
        nodes, begin, end = nodes[begin < end], begin[begin < end], end[begin < end]
        here = np.zeros(len(above), bool)
        here[nodes] = True
        asked = np.flatnonzero(np.repeat(here, many))
        begin, end, base = (np.repeat(x, many[nodes]) for x in (begin, end, self.base[above[nodes]]))
        out = np.full(len(value), -1)
        out[asked] = self.values.find(value[asked] + base, begin, end)
        return out

    def code(self, at: np.ndarray) -> np.ndarray:
        return np.where(at >= 0, self.codes[np.maximum(at, 0)], 0) if len(self.codes) else np.zeros(len(at), np.uint16)


class Trie:
    """Quantised log10 probabilities of pairs and triples of words."""

    def __init__(self, buffer: bytes):
        words, *rest = _parted(memoryview(buffer))
        self.words, self.pairs, self.triples = EliasFano(words), Level(*rest[:4]), Level(*rest[4:])

    @staticmethod
    def packed(first: np.ndarray, pairs: tuple, triples: tuple) -> bytes:
        """From the sorted first words and, for either level, (successors of each node above, values, codes)."""
        return _joined([EliasFano.packed(first), *Level.packed(*pairs), *Level.packed(*triples)])

    def codes(self, first: np.ndarray, seconds: np.ndarray, second: np.ndarray, thirds: np.ndarray, third: np.ndarray) -> tuple:
        """Codes of pairs and of triples, 0 for those not in here: `seconds` words follow each first one, `thirds` each pair."""
        pair = self.pairs.find(self.words.find(first), seconds, second)
        return self.pairs.code(pair), self.triples.code(self.triples.find(pair, thirds, third))
