"""Repeated passages against all windows of words."""

from __future__ import annotations

import random
from collections import defaultdict

from shopstream.llm.suffix_dedup import repeated_passages
from tests.llm.helpers import AWKWARD, docs, prose, tokens


def brute(rows, least):
    holders = defaultdict(set)
    for n, (_, text) in enumerate(rows):
        w = tokens(text)
        for i in range(len(w) - least + 1):
            holders[tuple(w[i : i + least])].add(n)
    out = []
    for doc, text in rows:
        w = tokens(text)
        covered = [False] * len(w)
        for i in range(len(w) - least + 1):
            if len(holders[tuple(w[i : i + least])]) > 1:
                covered[i : i + least] = [True] * least
        spans, start = [], None
        for i, c in enumerate([*covered, False]):
            if c and start is None:
                start = i
            elif not c and start is not None:
                spans.append((start, i))
                start = None
        if spans:
            out.append((doc, len(w), sum(covered), tuple(spans)))
    return sorted(out, key=str)


def found(spark, rows, least):
    return sorted(
        [(r.doc_id, r.n_words, r.n_repeated, tuple(tuple(s) for s in r.spans)) for r in repeated_passages(docs(spark, rows), least).collect()], key=str
    )


def test_passages(spark):
    rng = random.Random(8)
    passages = [prose(i, rng.randrange(45, 90), 10**6) for i in range(12)]
    rows = []
    for i in range(150):
        text = prose(1000 + i, rng.randrange(0, 200), 10**6)
        for passage in rng.sample(passages, rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text[at:at] = passage
        rows.append((i, " ".join(text)))
    assert found(spark, rows, 50) == brute(rows, 50)


def test_hot_passage_and_copies(spark):
    passage = " ".join(prose(1, 60, 10**6))
    rows = [(i, f"a{i} b{i} {passage} c{i}") for i in range(300)] + [(1000 + i, " ".join(prose(2, 80, 10**6))) for i in range(200)]
    assert found(spark, rows, 50) == brute(rows, 50)


def test_just_long_enough(spark):
    line = prose(3, 49, 10**6)
    rows = [(1, " ".join(["p", *line])), (2, " ".join(["q", *line])), (3, " ".join(["r", *line, "s"])), (4, " ".join(["t", *line, "s"]))]
    assert [r[0] for r in found(spark, rows, 50)] == [3, 4]


def test_neighbours_that_share_less(spark):
    # Many documents hold the middle of a passage only; two hold all of it, with other words around.
    passage = prose(11, 58, 10**6)
    rows = [(i, " ".join([*prose(100 + i, 9, 10**6), *passage[10:48], *prose(300 + i, 9, 10**6)])) for i in range(60)]
    rows += [(200 + i, " ".join([*prose(500 + i, 9, 10**6), *passage, *prose(600 + i, 9, 10**6)])) for i in range(2)]
    assert found(spark, rows, 50) == brute(rows, 50)
    assert [r[0] for r in brute(rows, 50)] == [200, 201]


def test_awkward_rows(spark):
    long = " ".join(prose(4, 55, 10**6))
    rows = [*AWKWARD, (None, long), (20, long + " tail"), (21, long), (21, long), (22, " ".join([long, "x", long]))]
    want = [r for r in brute(rows, 50) if r[0] != 8]  # repeats inside one document do not count
    got = found(spark, rows, 50)
    assert [r for r in got if r[0] != 22] == [r for r in want if r[0] != 22]
    assert [r[0] for r in got].count(22) == 1
    assert found(spark, [], 50) == []


def test_repeats_inside_a_document(spark):
    # Each pair shares one passage; one document has its clause once more before, or the whole passage twice.
    rows = []
    for i in range(60):
        passage = prose(2000 + i, 57, 10**6)
        clause = passage[: 32 + i % 18] if i % 3 else passage
        rows.append((2 * i, " ".join([*prose(3000 + i, 9, 10**6), *clause, *prose(4000 + i, 7, 10**6), *passage])))
        rows.append((2 * i + 1, " ".join([*prose(5000 + i, 9, 10**6), *passage, *prose(6000 + i, 9, 10**6)])))
    rows += [(200, "la " * 300), (201, "la " * 120 + "end"), (202, "x " + "la " * 49 + "y")]
    assert found(spark, rows, 50) == brute(rows, 50)


def test_hot_clause_with_two_surroundings(spark):
    # Documents of one variant share words before the clause, and neighbours may be of the other.
    rng = random.Random(5)
    rows = []
    for i in range(80):
        clause = prose(7000 + i, 60, 10**6)
        before, after = ([prose(base + 2 * i + v, 15, 10**6) for v in (0, 1)] for base in (8000, 9000))
        for j in range(6):
            text = [*before[rng.randrange(2)], *clause, *after[rng.randrange(2)]]
            rows.append((10 * i + j, " ".join([*prose(10**5 + 10 * i + j, 9, 10**6), *text, *prose(10**6 + 10 * i + j, 9, 10**6)])))
    assert found(spark, rows, 50) == brute(rows, 50)


def test_texts_are_not_multiplied_by_equal_ids(spark):
    """Three hundred texts without an id: one text row for each, in a plan that joins by the whole sequence."""
    from shopstream.llm import suffix_dedup

    rows = [(None, " ".join(prose(i, 60))) for i in range(150)] + [(3, " ".join(prose(i, 60))) for i in range(100, 300)]
    table = docs(spark, rows)
    made = suffix_dedup.features(table, 50, "doc_id", "text")
    key = ["seq_a", "seq_b", "n_words"]
    nodes = made.groupBy(*key).agg({"doc_id": "min"}).withColumnRenamed("min(doc_id)", "least").selectExpr("*", "seq_a AS node")
    found = suffix_dedup.node_texts(table, nodes, "doc_id", "text")
    assert found.count() == nodes.count() == 300
    assert {r.text for r in found.collect()} == {t for _, t in rows}
