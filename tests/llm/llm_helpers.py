"""Small documents and brute-force versions for the training-data operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, id long, token string, bucket int, part int, n int, label int, position long, _id int"


def rows_of(texts):
    return [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]


def words(rng, n, size=200):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    long_text = words(rng, 60_000, 3000)
    return [
        (1, None, "en", "a", 0), (2, "", None, "a", None), (3, " \n\t ", "en", None, 4), (None, "a null id here", "en", "a", 5),
        (4, "same text", "en", "a", 9), (5, "same text", "en", "b", 9), (5, "same text", "en", "b", 9),
        (6, long_text, "en", "b", len(long_text)), (7, "ü中\U0001F600 x", "de", "c", 5), (None, None, None, None, None),
    ]


def with_clashing(rows):
    return [(*r, 9, "t", 1, 2, 3, 1, 4, 5) for r in rows]


def shingles(text, size=5):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if len(w) >= size else frozenset([tuple(w)])


def components(docs, percent):
    """Smallest id reachable over links of ``percent`` similarity, by all pairs."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}
