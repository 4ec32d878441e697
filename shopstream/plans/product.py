"""Product performance: attributes, prices, conversion, ranks, tier and popularity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.functions.numerics import MONEY_UNITS, case_when, money, money_ratio, pct, ratio, rounded, units
from shopstream.operators.grains import distinct_if, entity_grains, of, type_sums, typed
from shopstream.operators.rank import attach_rank, rank_table
from shopstream.operators.silver import category_level
from shopstream.operators.state import GRAIN_SUMS, Partial
from shopstream.session import scratch_path

# Percentile bounds of the tiers and the popularity weights.
TIERS = ((90, "Top 10%"), (75, "Top 25%"), (50, "Top 50%"), (25, "Bottom 50%"))
LOWEST_TIER = "Bottom 25%"
POPULARITY_WEIGHTS = {"total_views": 0.2, "total_cart_adds": 0.3, "total_purchases": 0.5}

AGGREGATE_COLUMNS = (
    "product_id",
    "category_id",
    "category_code",
    "category_l1",
    "category_l2",
    "category_l3",
    "brand",
    "avg_price",
    "min_price",
    "max_price",
    "current_price",
    "total_events",
    "total_views",
    "total_cart_adds",
    "total_cart_removes",
    "total_purchases",
    "unique_users_total",
    "unique_users_viewed",
    "unique_users_carted",
    "unique_users_purchased",
    "unique_sessions",
    "total_revenue",
    "first_seen_date",
    "last_seen_date",
    "days_with_activity",
)
CORE = (
    "product_id",
    "category_id",
    "category_code",
    "category_l1",
    "brand",
    "avg_price",
    "total_events",
    "total_views",
    "total_cart_adds",
    "total_purchases",
    "unique_users",
    "total_revenue",
    "view_to_cart_rate",
    "cart_to_purchase_rate",
    "overall_conversion_rate",
)


DESCRIBED = ("category_id", "category_code", "brand")


def _offer_rows(silver: DataFrame) -> DataFrame:
    """Events collapsed to (product, attributes, price): there the text columns are
    hash keys, so the wide first/last search runs on few rows, and a popular product
    arrives as one row per distinct offer and task.
    """
    return (
        typed(silver, ["product_id", *DESCRIBED, "price", "event_time"])
        .groupBy("product_id", *DESCRIBED, "price")
        .agg(
            F.count("*").alias("n"),
            *type_sums(),
            F.min("event_time").alias("t_min"),
            F.max("event_time").alias("t_max"),
        )
    )


def _offers_of(rows: DataFrame) -> DataFrame:
    offers = rows.withColumn("price_units", units("price"))
    sold = F.sum(F.col("price_units") * F.col("purchases"))
    listed = F.sum(F.col("price_units") * F.col("n")).cast("double")
    per_product = offers.groupBy("product_id").agg(
        F.min(F.struct("t_min", *DESCRIBED)).alias("first"),
        F.max(F.struct("t_max", "price"))["price"].alias("current_price"),
        rounded(listed / (F.sum("n") * MONEY_UNITS)).alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum("n").alias("total_events"),
        F.sum("views").alias("total_views"),
        F.sum("carts").alias("total_cart_adds"),
        F.sum("removes").alias("total_cart_removes"),
        F.sum("purchases").alias("total_purchases"),
        money(sold).alias("total_revenue"),
    )
    levels = {f"category_l{n}": category_level("category_code", n) for n in (1, 2, 3)}
    return per_product.select("*", *[f"first.{c}" for c in DESCRIBED]).drop("first").withColumns(levels)


def _audience_rows(silver: DataFrame) -> DataFrame:
    return entity_grains(
        typed(silver, ["product_id", "user_id", "user_session", "event_date"]),
        ["product_id"],
        {"user": "user_id", "session": "user_session", "date": "event_date"},
        type_sums(),
    )


def _audience_of(grains: DataFrame) -> DataFrame:
    day = of("date", "event_date")
    return grains.groupBy("product_id").agg(
        distinct_if("user", "user_id").alias("unique_users_total"),
        distinct_if("user", "user_id", "views > 0").alias("unique_users_viewed"),
        distinct_if("user", "user_id", "carts > 0").alias("unique_users_carted"),
        distinct_if("user", "user_id", "purchases > 0").alias("unique_users_purchased"),
        distinct_if("session", "user_session").alias("unique_sessions"),
        F.min(day).alias("first_seen_date"),
        F.max(day).alias("last_seen_date"),
        distinct_if("date", "event_date").alias("days_with_activity"),
    )


# Attributes, prices, counts and revenue per product.
OFFERS = Partial(_offer_rows, _offers_of, {**GRAIN_SUMS, "t_min": "min", "t_max": "max"})
# Distinct users, sessions and days per product.
AUDIENCE = Partial(_audience_rows, _audience_of, GRAIN_SUMS)


def aggregate(silver: DataFrame) -> DataFrame:
    """One row per product. Attributes are those of its earliest event, the current
    price that of its latest; ties fall to the lowest attributes and the highest price.
    """
    return combine(OFFERS.apply(silver), AUDIENCE.apply(silver))


def combine(offers: DataFrame, audience: DataFrame) -> DataFrame:
    """The aggregates from their two finished parts."""
    return offers.join(audience, "product_id").select(*AGGREGATE_COLUMNS)


def derive(products: DataFrame) -> DataFrame:
    """Conversion and engagement rates from the aggregates."""
    return products.withColumns(
        {
            "view_to_cart_rate": pct("total_cart_adds", "total_views"),
            "cart_to_purchase_rate": pct("total_purchases", "total_cart_adds"),
            "overall_conversion_rate": pct("total_purchases", "total_views"),
            "cart_abandonment_rate": pct(
                "total_cart_adds - total_purchases", "total_cart_adds"
            ),
            "revenue_per_view": money_ratio("total_revenue", "total_views", 4),
            "views_per_session": ratio("total_views", "unique_sessions"),
            "purchase_user_ratio": pct("unique_users_purchased", "unique_users_viewed"),
            "avg_purchases_per_buyer": ratio("total_purchases", "unique_users_purchased"),
        }
    )


# Scopes of a rank: name of its column and the column it ranks within (None: everywhere).
RANKS = (("revenue_rank_global", None), ("revenue_rank_in_category", "category_l1"), ("revenue_rank_in_brand", "brand"))


def _ranked(products: DataFrame) -> DataFrame:
    """Revenue ranks with every task bounded, see ``operators.rank``; one pass over all scopes, one join back."""
    scopes = [F.struct(F.lit(i).alias("scope"), (F.col(by) if by else F.lit(None).cast("string")).alias("within")) for i, (_, by) in enumerate(RANKS)]
    placed = products.select("product_id", units("total_revenue").alias("value"), F.inline(F.array(*scopes)))
    ranks = rank_table(placed, "value", ["scope", "within"], "place", "share")
    found = attach_rank(placed, ranks, "value", ["scope", "within"])
    per_product = found.groupBy("product_id").agg(
        *[F.max(F.when(F.col("scope") == i, F.col("place"))).alias(name) for i, (name, _) in enumerate(RANKS)],
        F.max(F.when(F.col("scope") == 0, F.col("share"))).alias("_share"),
    )
    out = products.join(per_product.withColumnRenamed("product_id", "_of"), F.col("product_id").eqNullSafe(F.col("_of"))).drop("_of")
    return out.withColumn("revenue_percentile", rounded(F.col("_share") * 100)).drop("_share")


def rank_products(products: DataFrame) -> DataFrame:
    """Add ranks, percentile, tier and popularity to derived product rows, one for each product.

    The rows are read several times, so give those of a written table.
    """
    ranked = _ranked(products)
    share = "revenue_percentile"
    popularity = F.expr(" + ".join(f"{c} * {w}D" for c, w in POPULARITY_WEIGHTS.items()))
    return ranked.withColumns(
        {
            "performance_tier": case_when([(f"{share} >= {p}", t) for p, t in TIERS], LOWEST_TIER),
            "popularity_score": rounded(popularity),
        }
    )


def product_performance(silver: DataFrame, columns: str = "full", audit: bool = False) -> DataFrame:
    """The product gold table; ``columns="core"`` gives the compact pipeline variant.

    The percentile runs with revenue, so the best sellers get the top tier. The aggregates are written to the
    shared folder first: ranks compare all products, and read that small table instead of the events.
    """
    if columns == "core":
        users = silver.groupBy("product_id").agg(F.count_distinct("user_id").alias("unique_users"))
        rates = {
            "view_to_cart_rate": pct("total_cart_adds", "total_views"),
            "cart_to_purchase_rate": pct("total_purchases", "total_cart_adds"),
            "overall_conversion_rate": pct("total_purchases", "total_views"),
        }
        out = OFFERS.apply(silver).join(users, "product_id").withColumns(rates).select(*CORE)
    else:
        path = scratch_path(silver.sparkSession, "products")
        aggregate(silver).write.parquet(path)
        out = rank_products(derive(silver.sparkSession.read.parquet(path)))
    return out.withColumn("processed_timestamp", F.current_timestamp()) if audit else out
