"""Vector codes beside a computation with plain whole numbers."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from shopstream.llm import vector_codes

SCHEMA = "vec_id bigint, embedding array<{}>, label int, code string, size int, error int"


def table(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, n, "x", 1, 2) for i, v, n in rows], SCHEMA.format(kind))


def brute(rows, entries):
    kept = [(i, v, n) for i, v, n in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for length in {len(v) for _, v, _ in kept}:
        same = [(i, [math.floor(1024 * Fraction(x)) for x in v], n) for i, v, n in kept if len(v) == length]
        raw = [v for _, v, _ in kept if len(v) == length]
        order = sorted(range(len(same)), key=lambda k: (same[k][0] is None, same[k][0] or 0, raw[k]))[:entries]
        cuts = [(p * length // 4, (p + 1) * length // 4) for p in range(4)]
        books = [[same[k][1][a:b] for k in order] for a, b in cuts]

        def near(part, book):
            return min((sum((x - y) ** 2 for x, y in zip(part, e)), j) for j, e in enumerate(book))

        for _ in range(4):
            for p, (a, b) in enumerate(cuts):
                members = defaultdict(list)
                for _, v, _ in same:
                    members[near(v[a:b], books[p])[1]].append(v[a:b])
                books[p] = [[sum(c) // len(c) for c in zip(*members[j])] if members[j] else e for j, e in enumerate(books[p])]
        shown = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
        for i, v, n in same:
            best = [near(v[a:b], book) for (a, b), book in zip(cuts, books)]
            out.append((i, "".join(f"{j:02x}" for _, j in best), sum(d for d, _ in best), n, shown))
    totals = defaultdict(int)
    for *_, error, n, _ in out:
        totals[n] += error
    return sorted(((i, c, e, totals[n], s) for i, c, e, n, s in out), key=str)


def found(spark, rows, kind="double", **options):
    return sorted((tuple(r) for r in vector_codes.compress(table(spark, rows, kind), **options).collect()), key=str)


def vectors(seed, n, length, near=False):
    rng = random.Random(seed)
    values = [rng.uniform(-1, 1) for _ in range(5)] if near else None
    return [(i * 3, [rng.choice(values) if near else rng.uniform(-1, 1) for _ in range(length)], rng.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("length,near", [(8, False), (8, True), (10, False)])
def test_beside_a_direct_computation(spark, length, near):
    rows = vectors(length, 120, length, near)
    assert found(spark, rows, entries=16) == brute(rows, 16)


def test_awkward_rows(spark):
    rows = vectors(1, 30, 8)
    rows += [(1, None, 1), (2, [None] * 8, 1), (4, [1.0, math.nan] * 4, 1), (5, [math.inf] * 8, None)]
    rows += [(7, [0.5] * 8, None), (7, [0.25] * 8, 3), (7, [0.25] * 8, 3), (None, [0.1] * 8, 1), (None, [0.0] * 8, 1)]
    rows += [(8, [], 1), (9, [0.5, -0.5], 1), (10, [-0.5, 0.25], None), (11, [0.3] * 9, 2), (12, [-0.0] * 8, 2)]
    assert found(spark, rows, entries=256) == brute(rows, 256)
    assert found(spark, rows, entries=7) == brute(rows, 7)
    assert found(spark, []) == [] and found(spark, [(1, None, 1)]) == []


def test_large_numbers(spark):
    rows = [(i, [x * 1e5, -x, 7e4 * x, 1.0], 1) for i, x in enumerate([1.5, 2.5, -3.25, 9.0, 1.75, 8.0])]
    assert found(spark, rows, entries=3) == brute(rows, 3)
    far = [(i, [x, 1e15 * x, x, x], 1) for i, x in enumerate([1.0, -1.0, 2.0])]
    assert [r[2:4] for r in found(spark, far, entries=1)] == [(None, None)] * 3  # no long holds it


def test_single_precision(spark):
    rows = [(i, [float(np.float32(x)) for x in v], n) for i, v, n in vectors(4, 40, 16)]
    assert found(spark, rows, "float", entries=8) == brute(rows, 8)


def test_ties_go_to_the_lower_entry():
    part, entries = np.array([[1], [3], [-1]]), np.array([[0], [2], [2], [0]])
    index, least = vector_codes.nearest(part, entries)
    assert index.tolist() == [0, 1, 0] and least.tolist() == [1, 1, 1]
