"""Brute-force versions and awkward inputs for the tests of this folder."""

from __future__ import annotations

import random
import re
from itertools import combinations

DOC_SCHEMA = "doc_id bigint, text string, score int, spans string, node int, label int, words int"


def docs(spark, rows):
    """A table of (doc_id, text) with further columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, 1, "x", 2, 3, 4) for i, t in rows], DOC_SCHEMA)


AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "a"),
    (5, "same text again and again"),
    (5, "same text again and again"),
    (6, "same text again and again"),
    (None, "same text again and again"),
    (7, "x" * 20_000),
    (8, "lang " * 5_000),
    (9, "naïve ÉCOLE 漢字 🙂 ſ \x1c \u3000 end"),
]


def tokens(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())


def shingles(text: str | None, k: int) -> frozenset:
    w = tokens(text)
    if len(w) >= k:
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return frozenset([tuple(w)] if w else [])


def least_label(count: int, links) -> list[int]:
    """Smallest reachable number of each of ``count`` numbers."""
    label = list(range(count))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(x) for x in range(count)]


def jaccard_labels(rows, k: int, percent: int):
    """(size, component) of each row, all pairs compared; rows are in order of their ids."""
    sets = [shingles(t, k) for _, t in rows]
    links = [
        (a, b)
        for a, b in combinations(range(len(rows)), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return [(len(s), rows[c][0]) for s, c in zip(sets, least_label(len(rows), links))]


def prose(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
