"""Greedy string tiling against a direct version, and which documents it finds."""

from __future__ import annotations

import random

import numpy as np

from shopstream.llm.decontaminate import contaminated, tiling, without_contaminated
from tests.llm.helpers import AWKWARD, docs, prose


def brute_tiling(item, doc, least):
    free_item, free_doc, total = [True] * len(item), [True] * len(doc), 0
    while True:
        best = (0,)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and free_item[i + n] and free_doc[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return total
        n, i, j = best
        free_item[i : i + n] = free_doc[j : j + n] = [False] * n
        total += n


def test_tiling_matches_direct_version():
    rng = random.Random(2)
    for _ in range(150):
        item = [rng.randrange(4) for _ in range(rng.randrange(3, 30))]
        doc = [rng.randrange(4) for _ in range(rng.randrange(3, 60))]
        a, b = (np.array(x, np.uint64) + np.uint64(1) for x in (item, doc))
        tiles = tiling(a, b, np.ones(len(b), bool), 3)
        assert sum(n for *_, n in tiles) == brute_tiling(item, doc, 3)
        for i, j, n in tiles:
            assert item[i : i + n] == doc[j : j + n] and n >= 3
        for side, size in ((0, len(item)), (1, len(doc))):
            used = [p for t in tiles for p in range(t[side], t[side] + t[2])]
            assert len(used) == len(set(used)) and all(p < size for p in used)


def bench(spark, rows):
    return spark.createDataFrame([(i, t, 0.5) for i, t in rows], "item_id bigint, text string, coverage double")


ITEM = prose(1, 40, 10**6)


def test_verbatim_and_reordered(spark):
    def around(words, n):
        return " ".join([*prose(n, 50, 10**6), *words, *prose(n + 1, 50, 10**6)])

    rows = [
        (1, around(ITEM, 10)),
        (2, around([*ITEM[20:], "x", *ITEM[:20]], 20)),
        (3, around(ITEM[:12], 30)),
        (4, around([w.upper() for w in ITEM], 40)),
        (5, around([w for pair in zip(ITEM, prose(9, 40, 10**6)) for w in pair], 50)),
        (6, around([], 60)),
    ]
    items = [(7, " ".join(ITEM)), (7, " ".join(ITEM)), (8, "too short"), (9, None), (None, " ".join(ITEM))]
    found = contaminated(docs(spark, rows), bench(spark, items)).collect()
    # The item without an id is an item like any other.
    want = [(d, i, 1.0) for d in (1, 2, 4) for i in (7, None)]
    assert sorted(((r.doc_id, r.item_id, r.coverage) for r in found), key=str) == sorted(want, key=str)
    assert {r.doc_id: [tuple(t) for t in r.tiles] for r in found}[2] == [(0, 71, 20), (20, 50, 20)]
    clean = without_contaminated(docs(spark, rows), bench(spark, items))
    assert sorted(r.doc_id for r in clean.collect()) == [3, 5, 6] and clean.columns == docs(spark, []).columns


def test_passes_give_the_same(spark):
    items = [(i, " ".join(prose(i, 30, 10**6))) for i in range(40)]
    rows = [(i, " ".join(prose(500 + i, 30) + prose(i % 50, 30, 10**6))) for i in range(100)]
    both = [
        sorted((r.doc_id, r.item_id) for r in contaminated(docs(spark, rows), bench(spark, items), pass_bytes=n).collect())
        for n in (1 << 24, 2000)
    ]
    assert both[0] == both[1] == [(i, i % 50) for i in range(100) if i % 50 < 40]


def test_awkward_rows(spark):
    items = bench(spark, [(1, "same text again and again"), (2, "lang " * 6)])
    table = docs(spark, AWKWARD)
    found = contaminated(table, items).collect()
    assert sorted(((r.doc_id or 0), r.item_id) for r in found) == [(0, 1), (5, 1), (5, 1), (6, 1), (8, 2)]
    assert sorted((r.doc_id or 0) for r in without_contaminated(table, items).collect()) == [1, 2, 3, 4, 7, 9]
    assert contaminated(table, bench(spark, [])).count() == 0
    assert without_contaminated(table, bench(spark, [])).count() == len(AWKWARD)
    assert contaminated(docs(spark, []), items).count() == 0


def test_long_short_and_nameless_items(spark):
    long_item, nameless = prose(40, 180, 10**6), prose(41, 60, 10**6)
    items = bench(spark, [(1, " ".join(long_item)), (2, "four short words here"), (None, " ".join(nameless)), (3, None), (4, " "), (5, "singleton")])

    def around(words, n):
        return " ".join([*prose(n, 50, 10**6), *words, *prose(n + 1, 50, 10**6)])

    rows = [
        (1, around(long_item[70:130], 50)),
        (2, around(["Four", "short", "words", "HERE"], 52)),
        (3, around(nameless, 54)),
        (4, around(long_item[:49], 56)),
        (5, around(["four", "short", "words"], 58)),
        (6, around(["Singleton"], 60)),
        (7, "four short words"),
        (8, "four short words here"),
    ]
    found = {(r.doc_id, r.item_id): r for r in contaminated(docs(spark, rows), items).collect()}
    assert set(found) == {(1, 1), (2, 2), (3, None), (6, 5), (8, 2)}
    assert [tuple(t) for t in found[1, 1].tiles][0] == (70, 50, 60) and found[2, 2].coverage == 1.0
    kept = {r.doc_id for r in without_contaminated(docs(spark, rows), items).collect()}
    assert kept == {4, 5, 7}


def test_pairs_against_a_direct_search(spark):
    rng = random.Random(8)
    items = [(i, [f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 25))]) for i in range(12)]
    rows = []
    for d in range(60):
        words = [f"w{rng.randrange(30)}" for _ in range(rng.randrange(0, 40))]
        for _, item in rng.sample(items, 2):
            a = rng.randrange(len(item))
            at = rng.randrange(len(words) + 1)
            words[at:at] = item[a : a + rng.randrange(1, 20)]
        rows.append((d, " ".join(words)))
    want = set()
    for d, text in rows:
        words = text.split()
        for i, item in items:
            if len(item) < 5:
                hit = any(words[p : p + len(item)] == item for p in range(len(words)))
            else:
                runs = max((n for n in range(5, len(item) + 1) for a in range(len(item) - n + 1) if any(words[p : p + n] == item[a : a + n] for p in range(len(words) - n + 1))), default=0)
                hit = brute_tiling(item, words, 5) >= 0.5 * len(item) or runs >= 12
            if hit:
                want.add((d, i))
    found = contaminated(docs(spark, rows), bench(spark, [(i, " ".join(w)) for i, w in items]), long=12)
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got == want and len(want) > 20
