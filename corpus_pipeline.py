"""Preparing a corpus for training: five stages over ``documents``, each written as a table before the next reads it.

Each stage takes (session, documents, folder of test tables). All but the last return the columns of the documents.

Rows are judged by their own text, whatever their ids: those may be null or repeated. A null or empty text is handled like any other
(null stays null in the first four stages), very long texts whole; further columns, whatever their names, come along to the last
stage, which returns its own. An empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm import bpe_codec, decontaminate, ngram_join, quality_rules, secret_scan
from shopstream.llm.graph import written
from shopstream.llm.queries import fold

# The query's own decision.
REJECT_BELOW = 0.7
MASK = "[secret]"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the same fold of the labels as the query.

    Repeated rows are judged each, alike.
    """
    stats = quality_rules.with_statistics(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold("doc_id", 4) != 2)
    model = quality_rules.fit_on_labels(stats, labels)
    return quality_rules.filtered(docs, model, REJECT_BELOW)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by 80 % common five-word shingles.

    Repeated rows are copies. Texts without a word are linked with nothing and stay. A group with both null and other
    ids keeps one row of each kind.
    """
    return ngram_join.keep_one(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is covered by half of its words, or by 50 in a row; shorter items count whole."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret in the text masked; ``n_chars``, where there is one, follows the text."""
    masked = secret_scan.redact(docs, MASK)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256``: the identifiers, and a digest of the bytes they decode to; a null text is empty.

    The identifiers are written before they are decoded: in one pass each task would hold two Python workers, one for either side.
    """
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = written(bpe_codec.encode(docs, ranks, public_tokenizers.PATTERN), "identifiers")
    return bpe_codec.decode(encoded, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("byte-level BPE encoding and decoding", encoding),
]

# Trained rules and merges cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, from ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
