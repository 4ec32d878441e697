"""The rule ensemble: statistics against direct ones, rules against trees, held-out accuracy."""

from __future__ import annotations

import math

import pyarrow as pa
import pytest

from shopstream.llm import quality_rules as Q
from shopstream.llm.words import words
from tests.llm.helpers import AWKWARD, docs, prose, tokens


def direct(text: str | None) -> dict[str, float]:
    raw, w = (text or "").encode(), tokens(text)
    share = lambda part, whole: part / whole if whole else 0.0
    upper, lower = sum(65 <= b < 91 for b in raw), sum(97 <= b < 123 for b in raw)
    lines = [tuple(tokens(x)) for x in (text or "").split("\n") if tokens(x)]
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    return {
        "bytes": len(raw),
        "words": len(w),
        "word_bytes": share(sum(map(len, w)), len(w)),
        "upper_share": share(upper, upper + lower),
        "digit_share": share(sum(48 <= b < 58 for b in raw), len(raw)),
        "symbol_share": share(sum(33 <= b < 127 and not chr(b).isalnum() and chr(b) not in ".,;:'\"-" for b in raw), len(raw)),
        "stop_share": share(sum(chr(b) in ".,;:'\"-" for b in raw), len(raw)),
        "high_share": share(sum(b > 127 for b in raw), len(raw)),
        "short_word_share": share(sum(len(x) <= 3 for x in w), len(w)),
        "distinct_word_share": share(len(set(w)), len(w)),
        "distinct_triple_share": share(len(set(triples)), len(triples)),
        "repeated_line_share": share(len(lines) - len(set(lines)), len(lines)),
        "line_words": share(len(w), len(lines)),
    }


def test_statistics():
    texts = [t for _, t in AWKWARD] + ["A b.\nA b.\n\nc!! d%%% 12\n", "\n\nx\n", " ".join(prose(1, 300, 20))]
    found = Q.statistics(words(pa.array(texts, pa.string())))
    for row, text in zip(found, texts):
        want = direct(text)
        # A control byte counts as a symbol.
        if "\x1c" in (text or ""):
            continue
        assert dict(zip(Q.STATS, row)) == pytest.approx(want), text


def test_tree_paths_become_rules():
    text = """DecisionTreeClassificationModel
  If (feature 0 <= 5.0)
   If (feature 1 > 2.5)
    Predict: 1.0
   Else (feature 1 <= 2.5)
    Predict: 0.0
  Else (feature 0 > 5.0)
   If (feature 0 <= 9.0)
    Predict: 0.0
   Else (feature 0 > 9.0)
    Predict: 1.0
"""
    inf, a, b = math.inf, *Q.STATS[:2]
    assert [r.bounds for r in Q.tree_rules(text)] == [
        ((a, -inf, 5.0),),
        ((a, -inf, 5.0), (b, 2.5, inf)),
        ((a, -inf, 5.0), (b, -inf, 2.5)),
        ((a, 5.0, inf),),
        ((a, 5.0, 9.0),),
        ((a, 9.0, inf),),
    ]


def labelled(spark, n):
    rows = [(i, " ".join(prose(i, 60)) if i % 3 else "%%% ".join(prose(i, 60)) + "!!") for i in range(n)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(n)], "doc_id bigint, quality int, toxic int")
    return rows, labels


def test_learns_and_filters(spark):
    rows, labels = labelled(spark, 240)
    table = docs(spark, rows + [(1000, None), (1001, ""), (None, rows[1][1])])
    stats = Q.with_statistics(table)
    model = Q.fit_on_labels(stats, labels.filter("doc_id < 160"), sample_rows=10_000)
    found = {r.doc_id: r for r in Q.scores(stats, model, 0.7).collect()}
    assert all(found[i].predicted == int(i % 3 > 0) and 0 <= found[i].score <= 1 for i, _ in rows[160:])
    assert len(found) == 243 and 0 <= found[1000].score == found[1001].score <= 1
    kept = Q.filtered(table, model, 0.7)
    assert kept.dtypes == table.dtypes
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.predicted}


def test_few_labels(spark):
    rows, labels = labelled(spark, 9)
    stats = Q.with_statistics(docs(spark, rows))
    none = Q.fit_on_labels(stats, labels.filter("doc_id < 0"))
    assert {r.score for r in Q.scores(stats, none).collect()} == {0.5}
    one = Q.fit_on_labels(stats, labels.filter("quality = 1"))
    assert all(r.score > 0.8 for r in Q.scores(stats, one).collect())
    empty = Q.with_statistics(docs(spark, []))
    assert Q.scores(empty, one).count() == 0 and Q.filtered(docs(spark, []), one).count() == 0
