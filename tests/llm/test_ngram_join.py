"""The n-gram Jaccard join and components against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from shopstream.llm import ngram_join
from shopstream.llm.graph import components
from shopstream.llm.ngram_join import Classes, Sketches, forest, halved, jaccard_components, keep_one, overlaps, signatures, sketch
from shopstream.llm.words import shingle_sets, words
from tests.llm.helpers import AWKWARD, docs, jaccard_labels, least_label, prose, shingles


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        at = rng.randrange(len(out))
        out[at : at + rng.choice([0, 1, 1])] = [f"e{rng.randrange(10**6)}"] * rng.choice([0, 1, 1])
    return out


def families(seed, count, copies, length, most):
    rng = random.Random(seed)
    rows = []
    for f in range(count):
        base = prose(1000 * seed + f, rng.randrange(3, length))
        rows += [" ".join(edited(rng, base, rng.randrange(most + 1))) for _ in range(rng.randrange(1, copies))]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (2, 60)])
def test_families(spark, k, percent):
    rows = families(k, 40, 12, 150, 6)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs(spark, rows), k, percent).collect()}
    assert found == dict(zip([i for i, _ in rows], jaccard_labels(rows, k, percent)))


def test_large_group_around_the_bound(spark, monkeypatch):
    # Chunks of 8: the group is cut up, and links between its chunks are found in the second step.
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 8)
    rng = random.Random(9)
    base = prose(77, 120)
    rows = [(i, " ".join(edited(rng, base, rng.randrange(9)))) for i in range(120)]
    rows += [(200 + i, " ".join(prose(i, 100))) for i in range(20)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs(spark, rows), 3, 90).collect()}
    assert found == dict(zip([i for i, _ in rows], jaccard_labels(rows, 3, 90)))


def test_chain_of_links(spark):
    # Each text differs from the next by little, the ends by much.
    line = prose(5, 400, 10**6)
    rows = [(i, " ".join(line[2 * i : 2 * i + 100])) for i in range(60)]
    found = {r.component_id for r in jaccard_components(docs(spark, rows), 3, 90).collect()}
    assert found == {c for _, c in jaccard_labels(rows, 3, 90)} == {0}


def test_awkward_rows(spark):
    found = sorted(map(tuple, jaccard_components(docs(spark, AWKWARD), 3, 90).collect()), key=str)
    want = []
    for i, t in AWKWARD:
        same = [j for j, u in AWKWARD if j is not None and shingles(u, 3) and shingles(u, 3) == shingles(t, 3)]
        want.append((i, len(shingles(t, 3)), None if i is None else min(same, default=i)))
    assert found == sorted(want, key=str)
    kept = keep_one(docs(spark, AWKWARD), 3, 90)
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 9]
    assert kept.columns == docs(spark, []).columns
    assert jaccard_components(docs(spark, []), 3, 90).count() == keep_one(docs(spark, [])).count() == 0


def test_one_id_with_two_texts(spark):
    rows = [(1, "a b c d"), (1, "e f g h"), (2, "e f g h"), (3, "a b c d")]
    found = sorted(map(tuple, jaccard_components(docs(spark, rows), 3, 90).collect()))
    assert found == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1)]


def test_keep_one_judges_rows_by_their_texts(spark):
    rows = [(1, "a b c d"), (2, "e f g h"), (2, "a b c d"), (2, "i j k l"), (3, "I J K L"), (4, ""), (4, "")]
    rows += [(None, "m n o p"), (None, "m n o p"), (None, "q r s t"), (5, "u v w x"), (5, "u v w x")]
    kept = sorted(((r.doc_id, r.text) for r in keep_one(docs(spark, rows), 3, 90).collect()), key=str)
    want = [(1, "a b c d"), (2, "e f g h"), (2, "i j k l"), (4, ""), (4, ""), (5, "u v w x"), (None, "m n o p"), (None, "q r s t")]
    assert kept == sorted(want, key=str)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for percent in (50, 80, 90, 99):
        classes = Classes(percent)
        for _ in range(300):
            union = rng.integers(0, 2**64, rng.integers(1, 300), dtype=np.uint64)
            apart = int(len(union) * (100 - percent) / 100)
            cut = rng.integers(0, apart + 1)
            a, b = np.unique(union[cut:]), np.unique(np.concatenate([union[:cut], union[apart:]]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
                assert np.intersect1d(signatures(a, classes), signatures(b, classes)).size


def test_products():
    import pyarrow as pa

    texts = [" ".join(prose(i % 7, 40 + i % 3)) for i in range(40)] + ["", "one"]
    sets = shingle_sets(words(pa.array(texts)), 3)
    assert [len(s) for s in sets] == [len(shingles(t, 3)) for t in texts]
    shared = overlaps(sets)
    assert all(shared[i, j] == len(shingles(a, 3) & shingles(b, 3)) for i, a in enumerate(texts) for j, b in enumerate(texts) if i != j)
    assert all(root < member for root, member in forest(sets, 90))


def test_components(spark):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(50)] + [(100, j) for j in range(101, 140)]
    links += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = least_label(260, links)
    by_label = {}
    for node, label in found.items():
        by_label.setdefault(label, set()).add(want[node])
    assert all(len(s) == 1 for s in by_label.values()) and len(by_label) == len({want[n] for n in found})
    assert {a for a, b in links if a != b} <= set(found)
    assert components(spark.createDataFrame([(1, 1)], "a bigint, b bigint")).count() == 0


def test_texts_are_not_multiplied_by_equal_ids(spark):
    """Two hundred near copies with one id: as many text rows as sets, not their square."""
    rng = random.Random(4)
    base = prose(3, 120)
    rows = [(7, " ".join(edited(rng, base, 1 + i % 3))) for i in range(200)] + [(8, " ".join(base))]
    table = docs(spark, rows)
    made = ngram_join.features(table, 3, 90, "doc_id", "text")
    key = ["set_a", "set_b", "n_shingles"]
    nodes = made.groupBy(*key).agg({"doc_id": "min"}).withColumnRenamed("min(doc_id)", "least").selectExpr("*", "set_a AS node")
    found = ngram_join.node_texts(table, nodes, 3, "doc_id", "text")
    assert found.count() == nodes.count() == len({shingles(t, 3) for _, t in rows})
    # The id chooses rows and joins none: the only join that adds columns is on the whole key.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "set_a" in plan.split("Join Inner")[1].split("\n")[0]


def test_two_sides_of_a_product():
    import pyarrow as pa

    rng = random.Random(12)
    base = prose(6, 90)
    texts = [" ".join(edited(rng, base, rng.randrange(4))) for _ in range(30)]
    sets = shingle_sets(words(pa.array(texts)), 3)
    every = overlaps(sets)
    assert (overlaps(sets, 11) == every[:11, 11:]).all()
    exact = [shingles(t, 3) for t in texts]
    links = [(a, b) for a in range(11) for b in range(11, 30) if 100 * len(exact[a] & exact[b]) >= 90 * len(exact[a] | exact[b])]
    found = forest(sets, 90, 11)
    assert least_label(30, found) == least_label(30, links) and len(links) > len(found)


def test_signatures_of_most_sets_are_left_out():
    """Whatever the order of the signatures, linked sets still share one without the last ones that each may leave out."""
    rng = np.random.default_rng(3)
    for percent in (60, 80, 90):
        classes = Classes(percent)
        for _ in range(200):
            union = rng.integers(0, 2**64, rng.integers(20, 400), dtype=np.uint64)
            apart = int(len(union) * (100 - percent) / 100)
            cut = rng.integers(0, apart + 1)
            sets = np.unique(union[cut:]), np.unique(np.concatenate([union[:cut], union[apart:]]))
            left = []
            for s in sets:
                spares = [0, 0]
                found = signatures(s, classes, spares)
                # Those that both have are last in the order, which is the worst case.
                other = signatures(sets[1] if s is sets[0] else sets[0], classes)
                order = np.lexsort((found, np.isin(found, other)))
                for odd in (0, 1):
                    own = [x for x in found[order].tolist() if x % 2 == odd]
                    left.append((odd, set(own[: len(own) - spares[odd]])))
            both = len(np.intersect1d(*sets))
            if 100 * both >= percent * (len(sets[0]) + len(sets[1]) - both) and both < max(map(len, sets)):
                assert left[0][1] & left[2][1] or left[1][1] & left[3][1]


def test_sketches_never_lose_a_link():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    classes = Classes(80)
    base = rng.integers(0, 2**64, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.integers(0, 60) :], rng.integers(0, 2**64, rng.integers(0, 60), dtype=np.uint64)])) for _ in range(60)]
    sets += [np.unique(rng.integers(0, 2**64, 300, dtype=np.uint64)) for _ in range(20)]
    made = Sketches(pa.array([sketch(s, classes) for s in sets], pa.binary()), np.array([len(s) for s in sets]), 80)
    a, b = np.triu_indices(len(sets), 1)
    near = made.near(a, b)
    apart = np.array([len(np.setxor1d(sets[i], sets[j])) for i, j in zip(a, b)])
    linked = apart <= classes.apart(made.size[a], made.size[b])
    assert near[linked].all() and linked.any() and not near[apart > 2 * classes.apart(made.size[a], made.size[b])].any()
    rows = next(iter(made.rows.values()))
    assert halved(rows).shape[1] == rows.shape[1] // 2


def test_texts_that_share_a_passage_are_not_compared(spark, monkeypatch):
    """A passage common to many texts, of a third of each, puts no text into a tile; the near copies among them are found."""
    compared = []
    products = ngram_join.products
    monkeypatch.setattr(ngram_join, "products", lambda tiles, *a: compared.append(tiles.count()) or products(tiles, *a))
    passage = prose(1, 60)
    rows = [(i, " ".join(passage + prose(100 + i, 120))) for i in range(80)]
    rows += [(200 + i, " ".join(passage + prose(100 + i, 120) + ["more"])) for i in range(0, 80, 20)]
    found = {r.doc_id: r.component_id for r in jaccard_components(docs(spark, rows), 5, 80).collect()}
    assert found == dict(zip([i for i, _ in rows], (c for _, c in jaccard_labels(rows, 5, 80))))
    assert sum(compared) <= 16
