"""Row rules, quarantine, flags, quality report and duplicate search.

A rule is a SQL predicate that is true for a good row. A predicate that comes
out NULL counts as failed, so accepted and quarantined rows always add up to the
input. Everything that counts does so in one pass over the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.functions.numerics import first_match, pct
from shopstream.schema import EVENT_KEY, EVENT_TYPES, MALFORMED, PRICE_MAX, PRICE_MIN, REQUIRED

_ALLOWED = ", ".join(f"'{t}'" for t in EVENT_TYPES)

# Rule names and the predicates they stand for.
EXPECTATIONS: dict[str, str] = {
    "valid_event_time": "event_time IS NOT NULL",
    "valid_event_type": "event_type IS NOT NULL",
    "valid_product_id": "product_id IS NOT NULL",
    "valid_user_id": "user_id IS NOT NULL",
    "valid_price": "price IS NOT NULL",
    "event_type_in_allowed_values": f"event_type IN ({_ALLOWED})",
    "price_is_positive": f"price >= {PRICE_MIN}",
    "price_within_range": f"price <= {PRICE_MAX}",
    "product_id_is_positive": "product_id > 0",
    "user_id_is_positive": "user_id > 0",
    "category_id_is_positive": "category_id IS NULL OR category_id > 0",
}
CRITICAL: dict[str, str] = {
    "critical_event_time": "event_time IS NOT NULL",
    "critical_user_id": "user_id IS NOT NULL",
    "critical_product_id": "product_id IS NOT NULL",
}
PIPELINE_EXPECTATIONS: dict[str, str] = {
    "valid_event_time": "event_time IS NOT NULL",
    "valid_event_type": f"event_type IN ({_ALLOWED})",
    "valid_product_id": "product_id > 0",
    "valid_user_id": "user_id > 0",
    "valid_price": f"price BETWEEN {PRICE_MIN} AND {PRICE_MAX}",
}
# Fixed value: form of a session id.
SESSION_PATTERN = r"^[a-f0-9\-]{30,40}$"


def passes(predicate: str) -> Column:
    """A rule as a boolean that is never NULL."""
    return F.coalesce(F.expr(predicate), F.lit(False))


def is_valid(rules: Mapping[str, str] = PIPELINE_EXPECTATIONS, session_format: bool = False) -> Column:
    """All rules at once; optionally the session must look like a UUID too."""
    good = passes(conjunction(rules))
    if session_format:
        good = good & F.coalesce(F.col("user_session").rlike(SESSION_PATTERN), F.lit(False))
    return good


def conjunction(rules: Mapping[str, str]) -> str:
    """All rules as one SQL predicate."""
    return " AND ".join(f"({p})" for p in rules.values()) or "true"


def filter_valid(df: DataFrame, rules: Mapping[str, str] = PIPELINE_EXPECTATIONS) -> DataFrame:
    """The rows that meet all rules.

    A filter drops a row whose predicate is NULL, so none of the wrapping of ``is_valid`` is
    needed and comparisons of stored columns reach the Parquet scan.
    """
    return df.filter(conjunction(well_formed(df, rules)))


def well_formed(df: DataFrame, rules: Mapping[str, str]) -> Mapping[str, str]:
    """The rules, and that the record could be read, where the reader kept those that could not."""
    return {"well_formed": f"{MALFORMED} IS NULL", **rules} if MALFORMED in df.columns else rules


def quarantine_reason(malformed: bool = False) -> Column:
    """Name of the first defect in a fixed order of precedence; ``malformed`` if the column of kept lines is there."""
    first = [(F.col(MALFORMED).isNotNull(), "malformed")] if malformed else []
    named = (
        *first,
        (F.col("event_time").isNull(), "null_event_time"),
        (F.col("event_type").isNull(), "null_event_type"),
        (F.col("product_id").isNull(), "null_product_id"),
        (F.col("user_id").isNull(), "null_user_id"),
        (F.col("price").isNull(), "null_price"),
        (F.col("price") < PRICE_MIN, "negative_price"),
        (F.col("price") > PRICE_MAX, "price_above_max"),
        (~F.col("event_type").isin(*EVENT_TYPES), "invalid_event_type"),
        ((F.col("product_id") <= 0) | (F.col("user_id") <= 0), "non_positive_id"),
    )
    return first_match(named, "other")


def quarantined(
    df: DataFrame,
    rules: Mapping[str, str] = PIPELINE_EXPECTATIONS,
    with_reason: bool = True,
    at: Column | None = None,
) -> DataFrame:
    """The rows ``filter_valid`` leaves out, with the reason and, if given, a time."""
    out = df.filter(~is_valid(well_formed(df, rules)))
    extra = {"quarantine_timestamp": at} if at is not None else {}
    if with_reason:
        extra["quarantine_reason"] = quarantine_reason(MALFORMED in df.columns)
    return out.withColumns(extra) if extra else out


def apply(df: DataFrame, rules: Mapping[str, str], action: str = "drop") -> DataFrame:
    """Enforce rules: ``drop`` bad rows, ``warn`` (keep, listing broken rules) or ``fail`` the job."""
    if action == "drop":
        return filter_valid(df, rules)
    broken = F.array_compact(F.array(*[F.when(~passes(p), F.lit(n)) for n, p in rules.items()]))
    if action == "warn":
        return df.withColumn("failed_expectations", broken)
    if action == "fail":
        complaint = F.concat(F.lit("expectation failed: "), F.array_join(broken, ", "))
        return df.filter(F.when(is_valid(rules), F.lit(True)).otherwise(F.raise_error(complaint)))
    raise ValueError(f"unknown action {action!r}")


def expectation_counts(df: DataFrame, rules: Mapping[str, str] = EXPECTATIONS) -> DataFrame:
    """Rows (expectation, passed, failed), all counted by one aggregate."""
    tallies = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(passes(p)).alias(n) for n, p in rules.items()],
    )
    per_rule = F.array(*[F.struct(F.lit(n).alias("expectation"), F.col(n).alias("passed")) for n in rules])
    return tallies.select("total", F.inline(per_rule)).select(
        "expectation", "passed", (F.col("total") - F.col("passed")).alias("failed")
    )


def flag_completeness(df: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """Add the list of required columns that are NULL and whether it is empty."""
    gaps = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.withColumn("completeness_issues", gaps).withColumn(
        "is_complete", F.size("completeness_issues") == 0
    )


def flag_event_type(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "is_valid_event_type", F.coalesce(F.col("event_type").isin(*EVENT_TYPES), F.lit(False))
    )


def flag_price(df: DataFrame) -> DataFrame:
    return df.withColumn("is_valid_price", passes(f"price BETWEEN {PRICE_MIN} AND {PRICE_MAX}"))


def flag_ids(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_valid_product_id": passes("product_id > 0"),
            "is_valid_user_id": passes("user_id > 0"),
            "is_valid_category_id": passes("category_id IS NULL OR category_id > 0"),
        }
    )


def report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: totals, NULLs of each column, bad types and prices, score in percent."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count("*").alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
        F.count_if(~F.col("event_type").isin(*EVENT_TYPES)).alias("invalid_event_types"),
        F.count_if(~passes(f"price BETWEEN {PRICE_MIN} AND {PRICE_MAX}")).alias("out_of_range_prices"),
        F.count_if(is_valid()).alias("valid_records"),
    )
    return counted.withColumn("quality_score", pct("valid_records", "total_records"))


def report_dict(df: DataFrame) -> dict:
    """The report's one row as nested values; columns without NULLs are left out."""
    row = report(df).first().asDict()
    nulls = {k[len("null_"):]: v for k, v in row.items() if k.startswith("null_") and v}
    plain = {k: v for k, v in row.items() if not k.startswith("null_")}
    return {**plain, "null_counts": nulls}


def count_duplicates(df: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """One row: all rows, distinct keys and the surplus. NULL is a key value like any other."""
    return df.agg(
        F.count("*").alias("total_records"),
        F.count_distinct(F.struct(*keys)).alias("distinct_records"),
    ).withColumn("duplicate_records", F.col("total_records") - F.col("distinct_records"))


# Rows per generated block when identical copies are listed one by one.
COPY_BLOCK = 100_000


def duplicate_rows(
    df: DataFrame,
    keys: Sequence[str] = EVENT_KEY,
    order: Sequence[str] = ("ingestion_timestamp", "source_file"),
) -> DataFrame:
    """Every row but the first of its key, first meaning lowest in ``order``.

    Ties in ``order`` are settled by the remaining columns, so only fully equal
    rows are interchangeable. A key may hold any share of the table: equal rows
    collapse to a count on the map side, the first rows are found by another combined
    aggregate, the join of the two may be split by adaptive skew handling, and
    the rows are listed from their counts in bounded blocks.
    """
    lead = [c for c in order if c in df.columns and c not in keys]
    body = [*lead, *[c for c in df.columns if c not in keys and c not in lead]]
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)])
    row = F.struct(*body) if body else F.struct(F.lit(0).alias("_none"))
    distinct = (
        df.select(key.alias("_key"), row.alias("_row")).groupBy("_key", "_row").agg(F.count("*").alias("_n"))
    )
    firsts = (
        distinct.groupBy("_key")
        .agg(F.min("_row").alias("_first"), F.sum("_n").alias("_all"))
        .filter("_all > 1")
        .select(F.col("_key").alias("_first_key"), "_first")
    )
    surplus = (
        distinct.join(firsts, F.col("_key") == F.col("_first_key"))
        .select("_key", "_row", F.expr("_n - CAST(_row = _first AS INT)").alias("_n"))
        .filter("_n > 0")
    )
    names = [F.col(f"_key.k{i}").alias(c) for i, c in enumerate(keys)]
    return _repeat(surplus, "_n").select(*names, *[f"_row.{c}" for c in body]).select(*df.columns)


def _repeat(df: DataFrame, count: str) -> DataFrame:
    """Emit each row ``count`` times, in blocks that are spread over tasks."""
    last_block = F.floor((F.col(count) - 1) / COPY_BLOCK).cast("bigint")
    blocks = df.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
    size = F.least(F.lit(COPY_BLOCK).cast("bigint"), F.col(count) - F.col("_block") * COPY_BLOCK)
    spread = blocks.hint("rebalance").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), size)))
    return spread.drop(count, "_block", "_copy")
