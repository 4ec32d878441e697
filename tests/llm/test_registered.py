"""The registered queries and the pipeline on the smallest test set."""

from __future__ import annotations

import hashlib
import os
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import TESTDATA
from tests.llm.helpers import jaccard_labels, tokens
from tests.llm.test_secret_scan import brute as secrets_of
from tests.llm.test_suffix_dedup import brute as repeats_of
from tests.llm.test_tokens import PLAIN, library_count

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from compare import connect, difference
from shopstream.llm.queries import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")


def rows(spark, name):
    return {r[0]: r for r in queries()[name](spark, TESTDATA).collect()}


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()}


def test_all_are_registered():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries())


@pytest.mark.parametrize("name", ["op8_url_rules", "op12_divergence", "op13_vector_codes"])
def test_sql(spark, name):
    assert name in oracle_sql() and difference(spark, connect(TESTDATA), TESTDATA, name) is None


def test_quality_and_language(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{TESTDATA}/labels.parquet").collect()}
    found = rows(spark, "op1_quality")
    held = [i for i, r in found.items() if r.held_out and i in labels]
    assert sum(found[i].predicted == labels[i] for i in held) >= 0.9 * len(held)
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()}
    found = rows(spark, "op9_language_id")
    held = [i for i, r in found.items() if r.held_out]
    assert sum(found[i].lang_pred == langs[i] for i in held) >= 0.95 * len(held) > 0


def test_toxicity(spark, texts):
    found = rows(spark, "op11_toxicity")
    assert set(found) == set(texts)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out is not None for r in found.values())


def test_codec_and_counts(spark, texts):
    for i, r in rows(spark, "op2_bpe_codec").items():
        ids = PLAIN.encode_ordinary(texts[i])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[i].encode()).hexdigest()
    for i, r in rows(spark, "op5_token_count").items():
        n = library_count(texts[i])
        assert tuple(r) == (i, len(texts[i].encode()), n, n > 512)


def test_join_and_dedup(spark, texts):
    given = sorted(texts.items())
    found = rows(spark, "op3_ngram_join")
    assert [tuple(found[i])[1:] for i, _ in given] == jaccard_labels(given, 3, 90)
    found = rows(spark, "op4_suffix_dedup")
    assert sorted(found) == sorted(r[0] for r in repeats_of(given, 50))


def test_secrets(spark, texts):
    for i, r in rows(spark, "op6_secrets").items():
        want = secrets_of(texts[i])
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for k, *_ in want) for kind in ("assign", "access", "hex"))


def test_decontamination(spark, texts):
    items = {r.item_id: tokens(r.text.lower()) for r in spark.read.parquet(f"{TESTDATA}/benchmark.parquet").collect()}
    whole = {
        (i, n)
        for i, t in texts.items()
        for n, w in items.items()
        if b" " + b" ".join(w) + b" " in b" " + b" ".join(tokens(t.lower())) + b" "
    }
    found = {(r.doc_id, r.item_id) for r in queries()["op10_decontaminate"](spark, TESTDATA).collect()}
    assert whole <= found and len(found) <= len(whole) + 2


def test_nearest(spark):
    found = queries()["op7_nearest"](spark, TESTDATA)
    assert found.groupBy("query_id").agg(F.count("*").alias("n")).filter("n <> 20").count() == 0
    assert found.select("query_id").distinct().count() == 25


def test_pipeline_keeps_what_the_classifier_predicts(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, TESTDATA).collect()}
    predicted = {i for i, r in rows(spark, "op1_quality").items() if r.predicted == 1}
    assert kept == predicted


def test_pipeline(spark, texts):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    kinds, left = docs.dtypes, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.written(stage(spark, docs, TESTDATA), "stage")
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) <= left and set(ids) <= {r.doc_id for r in before.select("doc_id").collect()}
        left = len(ids)
        if (name, stage) != corpus_pipeline.STAGES[-1]:
            assert docs.dtypes == kinds
        if "Jaccard" in name:
            given = sorted((r.doc_id, r.text) for r in before.collect())
            assert sorted(ids) == sorted({c for _, c in jaccard_labels(given, 5, 80)})
        if "secret" in name:
            assert all(r.text == texts[r.doc_id] or secrets_of(texts[r.doc_id]) for r in docs.collect())
            assert docs.filter("n_chars <> length(text)").count() == 0
    text = {r.doc_id: r.text for r in before.collect()}
    for r in docs.collect():
        assert r.ids == PLAIN.encode_ordinary(text[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
