"""Bronze-shaped events derived from the star-schema test tables.

The tables hold no shop clickstream, so one is derived from ``events`` and
``part`` (hours and sessions spread over a month) and a larger one from
``lineitem`` and ``orders`` (years of days, prices above the accepted range).
Joins carry no broadcast hint: Spark broadcasts the dimension while its size is
below the session's threshold, otherwise adaptive skew handling splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.schema import BRONZE_SCHEMA


def read_parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_from_testdata(spark: SparkSession, sf_dir: str, redeliver: bool = True) -> DataFrame:
    """Bronze events from ``events`` and ``part``, with dirt in every column.

    ``error`` events keep their name and so are invalid; ids of 0 are invalid;
    small parts have no category and one brand is withheld; text is padded.
    With ``redeliver`` every purchase arrives a second time a day later, in
    capitals, as an at-least-once feed would send it.
    """
    events = read_parquet(spark, sf_dir, "events")
    part = read_parquet(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_size").cast("bigint").alias("category_id"),
        F.when(
            F.col("p_size") > 5,
            F.concat(
                F.lit(" "), F.lower("p_type"), F.lit("."), F.translate("p_name", " ", "."), F.lit(" ")
            ),
        ).alias("category_code"),
        F.when(F.col("p_brand") != "Brand#1", F.concat(F.lit(" "), F.col("p_brand"))).alias("brand"),
    )
    kind = F.col("event_type")
    shaped = events.select(
        F.col("ts").cast("timestamp").alias("event_time"),
        F.when(kind == "click", "cart")
        .when(kind == "signup", "remove_from_cart")
        .otherwise(kind)
        .alias("event_type"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        F.col("value").alias("price"),
        "user_id",
        F.concat(
            F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string")
        ).alias("user_session"),
    )
    first = F.struct(
        F.col("event_type").alias("event_type"),
        (F.col("event_time") + F.expr("INTERVAL 1 HOUR")).alias("ingestion_timestamp"),
        F.lit("feed/first.csv").alias("source_file"),
    )
    again = F.struct(
        F.upper("event_type").alias("event_type"),
        (F.col("event_time") + F.expr("INTERVAL 25 HOURS")).alias("ingestion_timestamp"),
        F.lit("feed/again.csv").alias("source_file"),
    )
    copies = F.array(first)
    if redeliver:
        copies = F.when(F.col("event_type") == "purchase", F.array(first, again)).otherwise(copies)
    delivered = (
        shaped.withColumn("delivery", F.explode(copies))
        .drop("event_type")
        .select("*", "delivery.*", F.col("delivery.ingestion_timestamp").alias("created_at"))
        .drop("delivery")
    )
    return delivered.join(part, "product_id", "left").select(*BRONZE_SCHEMA.names)


def events_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze events from ``lineitem``, ``orders`` and ``part``; one order is one session."""
    line = read_parquet(spark, sf_dir, "lineitem")
    orders = read_parquet(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = read_parquet(spark, sf_dir, "part").select(
        F.col("p_partkey"),
        F.col("p_size").cast("bigint").alias("category_id"),
        F.concat(F.lower("p_type"), F.lit("."), F.translate("p_name", " ", ".")).alias("category_code"),
        F.col("p_brand").alias("brand"),
    )
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    kind = (
        F.when((flag == "R") & (status == "F"), "purchase")
        .when((flag == "R") & (status == "O"), "remove_from_cart")
        .when((flag == "N") & (status == "O"), "cart")
        .otherwise("view")
    )
    return (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(
            F.col("l_shipdate").cast("timestamp").alias("event_time"),
            kind.alias("event_type"),
            (F.col("l_partkey") + 1).alias("product_id"),
            "category_id",
            "category_code",
            "brand",
            F.col("l_extendedprice").alias("price"),
            (F.col("o_custkey") + 1).alias("user_id"),
            F.col("l_orderkey").cast("string").alias("user_session"),
            (F.col("l_shipdate").cast("timestamp") + F.expr("INTERVAL 1 HOUR")).alias(
                "ingestion_timestamp"
            ),
            F.lit("feed/orders.csv").alias("source_file"),
            (F.col("l_shipdate").cast("timestamp") + F.expr("INTERVAL 1 HOUR")).alias("created_at"),
        )
    )
