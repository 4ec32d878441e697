"""Small lookup tables taken from the events, and joining them back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.operators.silver import category_level


def products_dim(silver: DataFrame) -> DataFrame:
    """Latest category, brand and price of every product; ties go to the highest values."""
    offer = ["category_id", "category_code", "brand", "price"]
    latest = (
        silver.groupBy("product_id", *offer)
        .agg(F.max("event_time").alias("last_seen"))
        .groupBy("product_id")
        .agg(F.max(F.struct("last_seen", *offer)).alias("latest"))
    )
    out = latest.select("product_id", *[f"latest.{c}" for c in offer])
    return out.withColumn("category_l1", category_level("category_code", 1))


def users_dim(silver: DataFrame) -> DataFrame:
    """First and last day and the number of events of every user."""
    return silver.groupBy("user_id").agg(
        F.min("event_date").alias("first_seen_date"),
        F.max("event_date").alias("last_seen_date"),
        F.count("*").alias("total_events"),
    )


def enrich(
    events: DataFrame, dim: DataFrame, key: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Add dimension columns, prefixed ``dim_``; events without a match keep NULLs.

    No broadcast is forced: Spark takes one while the dimension is under the session's
    ``autoBroadcastJoinThreshold`` by its measured size, and otherwise joins by
    shuffle, where adaptive execution splits hot keys on the event side.
    """
    columns = columns or [c for c in dim.columns if c != key]
    side = dim.select(key, *[F.col(c).alias(f"dim_{c}") for c in columns])
    return events.join(side, key, "left")
