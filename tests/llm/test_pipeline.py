"""The stages of the pipeline on awkward tables."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from tests.conftest import TESTDATA
from tests.llm.helpers import AWKWARD

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score int, `row` int, node int, spans string"


def table(spark, rows):
    given = spark.read.parquet(f"{TESTDATA}/documents.parquet").orderBy("doc_id").limit(12).collect()
    clean = [(1000 + r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in given] if rows else []
    awkward = [(i, t, None, None, None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame([(*r, 1, 2, 3, "x") for r in clean + awkward], SCHEMA)


def test_awkward_rows_pass_all_stages(spark):
    docs = table(spark, AWKWARD + [(20, "word " * 50_000), (None, None), (None, "")])
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        kinds = docs.dtypes
        docs = corpus_pipeline.written(stage(spark, docs, TESTDATA), "stage")
        assert docs.count() <= before
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.dtypes == kinds
        before = docs.count()
    assert before > 0 and "decoded_sha256" in docs.columns


def test_empty_tables_and_columns_that_are_missing(spark):
    docs = table(spark, [])
    assert docs.count() == 0
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, TESTDATA), "stage")
        assert docs.count() == 0
    bare = spark.createDataFrame([(1, "password = abcdefgh1234")], "doc_id bigint, text string")
    assert corpus_pipeline.secrets(spark, bare, TESTDATA).columns == bare.columns


def test_decisions_take_effect(spark):
    long = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    docs = spark.createDataFrame([(i, long, "en", "s", len(long)) for i in (1, 2, None)] + [(3, None, "en", "s", None)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.near_duplicates(spark, docs, TESTDATA).collect()
    # One of each kind of id stays; a text without words is like no other.
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 3]
    masked = corpus_pipeline.secrets(spark, spark.createDataFrame([(1, "password = abcdefgh1234", 23)], "doc_id bigint, text string, n_chars bigint"), TESTDATA).first()
    assert "abcdefgh1234" not in masked.text and masked.n_chars == len(masked.text)


def test_a_task_of_the_last_stage_needs_one_worker(spark):
    docs = table(spark, AWKWARD)
    made = corpus_pipeline.encoding(spark, docs, TESTDATA)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert {(r.doc_id, r.n_tokens) for r in made.collect()} >= {(1, 0), (2, 0)}
    assert made.count() == docs.count()
