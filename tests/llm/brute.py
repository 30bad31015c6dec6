"""Plain versions of what the operators compute, and odd inputs they all must bear."""
import re
import string
import zlib
from collections import Counter
from itertools import combinations

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, label string, node long"

LONG = " ".join(f"word{i % 977} und{i % 13}" for i in range(30_000))
ODD = [
    (0, None, "en", "a", 0), (1, "", "en", "a", 0), (2, " \n\t ", None, None, 4), (3, "one", "en", "b", 3),
    (4, "One two THREE", "en", "b", 13), (5, "The cat sat on the mat. " * 20, "en", "c", 480),
    (6, "The cat sat on the mat. " * 20, "en", None, 480), (7, "The cat sat on the mat. " * 20, "de", "a", 480),
    (8, "éß 😀 中文 Ünï", "fr", "é", 12), (9, LONG, "de", "a", len(LONG)), (10, LONG + " end", "de", "a", len(LONG) + 4),
    (11, "12 34 .. !!", None, "z", 11), (12, "x" * 30_000, "en", "a", 30_000), (13, "1" * 30_000, "en", "a", 30_000),
    (14, "call me\nline one\nline two\n\nline three", "en", "a", 38),
]
ODD = [(*row, "s", "l", 5) for row in ODD]
# Repeated rows, a null id, and an id that repeats with another text.
REPEATED = [*ODD, ODD[5], ODD[5], (None, "no id here at all, really", "en", "a", 25, "s", "l", 5),
            (4, "another text under the same id", "en", "b", 30, "s", "l", 5)]


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def blank_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]


def shingles(text, width):
    words = blank_words(text)
    return {tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def near_components(docs, width):
    """{doc_id: (set size, least id reachable)} by comparing every pair."""
    sets = {i: shingles(t, width) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shared = Counter()
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    for ids in holders.values():
        shared.update(combinations(sorted(ids), 2))
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}
