"""Toxicity: segments, laws and scores beside direct versions, accuracy on documents not learned from, case rules."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from shopstream.llm import toxicity
from shopstream.llm.letters import letter_words, terms
from tests.llm.helpers import AWKWARD, docs, prose

BAD = ["vile", "grim", "foul", "nasty", "Übel"]


def brute_segments(scores):
    """Segments whose proper prefixes and suffixes all sum to more than zero, and that lie in no longer such segment."""
    n = len(scores)
    good = []
    for i in range(n):
        for j in range(i, n):
            part = scores[i : j + 1]
            if sum(part) > 0 and all(sum(part[:k]) > 0 and sum(part[k:]) > 0 for k in range(1, len(part))):
                good.append((i, j))
    inside = lambda a, b: b[0] <= a[0] and a[1] <= b[1] and a != b
    return sorted((i, j, sum(scores[i : j + 1])) for i, j in good if not any(inside((i, j), o) for o in good))


def runs_of(scores):
    sums, low, high, at = [0], [], [], []
    for s in scores:
        sums.append(sums[-1] + s)
    i = 0
    while i < len(scores):
        j = i
        while j < len(scores) and scores[j] > 0:
            j += 1
        if j > i:
            low.append(sums[i])
            high.append(sums[j])
            at.append((i, j - 1))
        i = max(j, i + 1)
    return low, high, at


def test_maximal_segments():
    rng = random.Random(3)
    for _ in range(400):
        scores = [rng.randrange(-6, 6) for _ in range(rng.randrange(0, 18))]
        low, high, at = runs_of(scores)
        found = [(at[i][0], at[j][1], s) for i, j, s in toxicity.maximal(low, high)]
        assert found == brute_segments(scores), scores


def test_many_runs_take_linear_time():
    low, high = list(range(0, -300_000, -1)), [x + 1 for x in range(0, -300_000, -1)]
    assert len(toxicity.maximal(low, high)) >= 1


def test_terms():
    w = letter_words(pa.array(["Ab1cD-é É", None, "", "漢字,x"]))
    assert terms(w).to_pylist() == ["ab", "cd", "é", "É", "漢字", "x"] and np.diff(w.first).tolist() == [4, 0, 0, 2]


def test_term_scores():
    toxic, other = np.array([50, 5, 0, 0]), np.array([0, 400, 300, 0])
    found = toxicity.term_scores(toxic, other) / toxicity.UNIT
    n1, n0 = 55, 700
    weight = toxicity.PRIOR * (n1 + n0)
    for i in range(3):
        p = toxicity.PRIOR * (toxic[i] + other[i])
        a, b = toxic[i] + p, other[i] + p
        odds = math.log(a / (n1 + weight - a)) - math.log(b / (n0 + weight - b))
        want = odds - toxicity.SURE * math.sqrt(1 / a + 1 / b) - toxicity.MARGIN
        assert found[i] == pytest.approx(min(max(want, toxicity.LOW), toxicity.HIGH), abs=1e-3)
    assert found[0] > 0 > found[2] and found[3] == toxicity.LOW


def test_law_of_chance():
    rng = np.random.default_rng(5)
    size = rng.integers(50, 2000, 4000)
    # Best of n segments by chance: P(best < s) = exp(-k n e^(-rate s)).
    best = -np.log(-np.log(rng.random(4000)) / (0.02 * size)) / 1.4
    rate, k = toxicity.fit_chance(size, np.maximum(best, 0) * toxicity.UNIT)
    assert rate == pytest.approx(1.4, rel=0.05) and k == pytest.approx(0.02, rel=0.15)
    assert toxicity.fit_chance(size, np.zeros(4000))[0] == 1.0


def test_evidence():
    one = toxicity.evidence(500, [6000], 1.0, 0.01)
    assert toxicity.evidence(500, [], 1.0, 0.01) == 0
    assert toxicity.evidence(500, [6000] * 4, 1.0, 0.01) > one > toxicity.evidence(5000, [6000], 1.0, 0.01)


def corpus(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(seed * 1000 + i, rng.randrange(20, 120))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randrange(3, 8)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        # Letters only: the digits of the invented words become letters.
        rows.append((i, re.sub(r"\d", lambda m: "abcdefghij"[int(m[0])], " ".join(words)), int(toxic)))
    return rows


def test_held_out_documents(spark):
    rows = corpus(400, 1)
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id bigint, toxic int")
    table = docs(spark, [r[:2] for r in rows])
    model = toxicity.fit(table, labels.filter("doc_id % 3 <> 1"))
    found = {r.doc_id: r for r in toxicity.scores(table, model).collect()}
    held = [(i, text, t) for i, text, t in rows if i % 3 == 1]
    assert sum(found[i].predicted == t for i, _, t in held) >= 0.97 * len(held)
    for i, text, t in rows:
        for p in found[i].passages:
            shown = text[p.start : p.end]
            assert shown.split()[0] in {b for b in BAD} | {b.lower() for b in BAD} or p.expected <= 0.01
            assert not text[p.start - 1 : p.start].isalpha() and not text[p.end : p.end + 1].isalpha()
    direct_scores(found, rows, model)


def direct_scores(found, rows, model):
    """Every score again: terms by an expression, segments by all pairs of places."""
    for i, text, _ in rows[:60]:
        words = re.findall(r"[A-Za-z\u0080-\U0010ffff]+", text)
        w = letter_words(pa.array([text]))
        scores = model.terms[toxicity.bins(w)].tolist()
        assert len(scores) == len(words)
        low, high, at = runs_of(scores)
        segments = [s for *_, s in brute_segments([s for a, b in at for s in [sum(scores[a : b + 1])]])] if len(at) < 2 else [
            s for *_, s in brute_segments(compressed(scores))
        ]
        x = toxicity.evidence(len(words), segments, model.rate, model.size)
        assert found[i].score == pytest.approx(1 / (1 + math.exp(-(model.offset + model.slope * x))), rel=1e-12)


def compressed(scores):
    """Neighbours of one sign added up: the segments stay the same."""
    out = []
    for s in scores:
        if out and (out[-1] > 0) == (s > 0):
            out[-1] += s
        else:
            out.append(s)
    return out


def test_awkward_rows(spark):
    rows = corpus(120, 2)
    labels = spark.createDataFrame([(i, t) for i, _, t in rows] + [(None, 1), (0, 0), (3, None), (5, 7)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs(spark, [r[:2] for r in rows] + [(0, "again"), (None, "vile")]), labels)
    awkward = AWKWARD + [(10, "vile foul grim " * 30_000), (11, "VILE, foul! grim? vile_grim")]
    found = toxicity.scores(docs(spark, awkward), model).collect()
    assert len(found) == len(awkward) and all(0 <= r.score <= 1 for r in found)
    by = {r.doc_id: r for r in found}
    assert by[1].score == by[2].score == by[3].score == min(r.score for r in found) and not by[1].passages
    assert by[10].predicted == by[11].predicted == 1 and by[10].passages[0].start == 0
    assert toxicity.scores(docs(spark, []), model).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, 1)]])
def test_without_both_labels(spark, labels):
    table = docs(spark, [(1, "a b c"), (2, "d"), (3, None)])
    model = toxicity.fit(table, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    share = (sum(t for _, t in labels) + 1) / (len(labels) + 2)
    assert [r.score for r in toxicity.scores(table, model).collect()] == pytest.approx([share] * 3)
