"""What Python workers hold while a task runs and after it."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa
import pytest

from shopstream.llm import arrow, ngram_join, quality_rules
from shopstream.llm.quality_rules import STATS, Model, Rule
from tests.llm.helpers import prose


def tasks_of(spark, monkeypatch, operator):
    """The function that a task of the operator runs over its batches."""
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    seen = []
    monkeypatch.setattr(arrow, "map_arrow", lambda df, run, schema: seen.append(run) or df.sparkSession.createDataFrame([], schema))
    operator(docs)
    return seen[0]


def batch(rows: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"doc_id": list(range(rows)), "text": [" ".join(prose(i, 400)) for i in range(rows)]})


MODEL = Model(0.0, ((Rule(((STATS[0], 0.0, 9.0),)), 1.0),))
OPERATORS = {
    "statistics": quality_rules.document_statistics,
    "filtered": lambda docs: quality_rules.filtered(docs, MODEL),
    "features": lambda docs: ngram_join.features(docs, 5, 80, "doc_id", "text"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_task_holds_little_beyond_its_batch(spark, monkeypatch, name):
    run = tasks_of(spark, monkeypatch, OPERATORS[name])
    given = batch(2_000)
    assert given.nbytes > 1.5 * arrow.BLOCK_BYTES
    rows = sum(made.num_rows for made in run(iter([batch(10)])))  # tables that are made once
    tracemalloc.start()
    try:
        rows += sum(made.num_rows for made in run(iter([given])))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 2_010
    assert most < 70e6


@pytest.mark.parametrize("stop_early", [False, True])
def test_a_task_gives_memory_back_at_its_end(spark, monkeypatch, stop_early):
    calls = []
    monkeypatch.setattr(arrow, "give_back", lambda: calls.append(1))
    task = tasks_of(spark, monkeypatch, quality_rules.document_statistics)(iter([batch(3), batch(4)]))
    assert next(task).num_rows == 3 and not calls
    if stop_early:
        task.close()
    else:
        assert [made.num_rows for made in task] == [4]
    assert calls == [1]


def test_large_groups_give_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(arrow, "give_back", lambda: calls.append(1))
    same = arrow.lean(lambda table: table)
    small, large = pa.table({"x": [1, 2]}), pa.table({"x": pa.array(range(arrow.LARGE_GROUP // 8 + 1), pa.int64())})
    assert same(small) is small and not calls
    assert same(large) is large and calls == [1]


def test_giving_back_keeps_what_is_in_use():
    kept = pa.array(range(100_000))
    arrow.give_back()
    assert kept[99_999].as_py() == 99_999
