"""The registered query of each operator of this subpackage, as a function of (session, folder of test tables)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm import (
    bpe_codec,
    decontaminate,
    divergence,
    language_id,
    nearest,
    ngram_join,
    quality_rules,
    secret_scan,
    suffix_dedup,
    token_count,
    toxicity,
    url_rules,
    vector_codes,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, n: int):
    """Remainder of the CRC-32 of an id's decimal text."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n))


def op1_quality(spark, d):
    stats = quality_rules.with_statistics(table(spark, d, "documents"))
    labels = table(spark, d, "labels").filter(fold("doc_id", 4) != 2)
    model = quality_rules.fit_on_labels(stats, labels)
    return quality_rules.scores(stats, model, 0.7).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted"
    )


def op2_bpe_codec(spark, d):
    """Every text encoded, the identifiers decoded again, and digests of both."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe_codec.encode(table(spark, d, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe_codec.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_ngram_join(spark, d):
    return ngram_join.jaccard_components(table(spark, d, "documents"), k=3, percent=90)


def op4_suffix_dedup(spark, d):
    return suffix_dedup.repeated_passages(table(spark, d, "documents"), least=50)


def op5_token_count(spark, d):
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_count.token_counts(table(spark, d, "documents"), tokenizer, limit=512)


def op6_secrets(spark, d):
    found = secret_scan.scan(table(spark, d, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secret_scan.listed("spans", secret_scan.BASE).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed("spans", secret_scan.KINDS).alias("spans"),
    )


# The rules that the query's contract names.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op7_nearest(spark, d):
    return nearest.search(table(spark, d, "embeddings"), "id % 20 = 0", k=20)


def op8_url_rules(spark, d):
    rules = spark.createDataFrame(URL_RULES, url_rules.RULES_SCHEMA)
    return url_rules.judge(table(spark, d, "pages"), rules)


def op9_language_id(spark, d):
    docs = table(spark, d, "documents")
    model = language_id.fit(docs.filter(fold("doc_id", 3) != 1))
    return language_id.identify(docs, model).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "languages"
    )


def op10_decontaminate(spark, d):
    return decontaminate.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op11_toxicity(spark, d):
    docs = table(spark, d, "documents")
    model = toxicity.fit(docs, table(spark, d, "labels").filter(fold("doc_id", 4) != 2))
    return toxicity.scores(docs, model, 0.3).select(
        "doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted", "passages"
    )


def op12_divergence(spark, d):
    return divergence.audit(table(spark, d, "documents"), least=30, top=50)


def op13_vector_codes(spark, d):
    return vector_codes.compress(table(spark, d, "embeddings"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_bpe_codec": op2_bpe_codec,
    "op3_ngram_join": op3_ngram_join,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_token_count": op5_token_count,
    "op6_secrets": op6_secrets,
    "op7_nearest": op7_nearest,
    "op8_url_rules": op8_url_rules,
    "op9_language_id": op9_language_id,
    "op10_decontaminate": op10_decontaminate,
    "op11_toxicity": op11_toxicity,
    "op12_divergence": op12_divergence,
    "op13_vector_codes": op13_vector_codes,
}
