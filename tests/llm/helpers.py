"""Plain Python twins of what the operators compute, and small tables with awkward rows."""

from __future__ import annotations

import random
import re
from collections import Counter

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORDS.findall(text or "")


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    """doc_id -> smallest reachable doc_id, by all pairs; rows of one doc_id are one document."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in up}


def removed_words(rows):
    """Per row (in order of doc_id, null first, then as given): which words a repeated 20-word window covers."""
    first, out = set(), {}
    for k, (_, text) in sorted(enumerate(rows), key=lambda r: (r[1][0] is not None, r[1][0] or 0, r[0])):
        w = words(text)
        gone = set()
        for p in range(len(w) - 19):
            window = tuple(w[p : p + 20])
            if window in first:
                gone.update(range(p, p + 20))
            first.add(window)
        out[k] = gone
    return out


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward(rng: random.Random) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls in any column, empty, long, repeated and tied rows, near copies."""
    base, passage = prose(rng, 120), prose(rng, 30, 9999)
    rows = [
        (1, base, "en", "a", 5), (2, base, "en", "a", 5), (3, base.upper(), None, "a", None), (4, None, "en", "b", 0),
        (5, "", "en", "b", 0), (6, " \n\t ", "en", None, 4), (None, base, "en", None, 1), (None, None, None, None, None),
        (7, "one two three", "en", "c", 13), (8, "one  two\nthree", "de", "c", 14), (9, "one two four", "de", "c", 1),
        (10, prose(rng, 30_000, 9999), "en", "d", 1), (11, prose(rng, 60, 9999) + " " + passage, "en", "a", 1),
        (12, passage + " " + prose(rng, 60, 9999), "en", "a", 1), (12, passage + " " + prose(rng, 50, 9999), "en", "a", 1),
        (13, base, "en", "a", 5), (13, base, "en", "a", 5), (1, "", "en", "a", 0), (21, None, "en", "a", 0), (14, "the same few words " * 60, "en", "a", 1),
        (15, "été café au lait \U0001f600 naïve", "fr", "e", 1),
    ]
    w = base.split()
    for k in range(20, 45):  # copies with some words changed, around the threshold
        own = list(w)
        for _ in range(k % 6):
            own[rng.randrange(len(own))] = f"x{rng.randrange(999)}"
        rows.append((k, " ".join(own), "en", "a", 1))
    return rows


def counted(rows) -> Counter:
    return Counter(tuple(r) for r in rows)
