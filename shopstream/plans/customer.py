"""Customer metrics: activity, value, favourites, RFM scores, segment and churn risk."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.functions.numerics import case_when, money, pct, ratio, safe_ratio
from shopstream.operators.grains import (
    ENTITY,
    distinct_if,
    entity_grains,
    of,
    total,
    type_sums,
    typed,
)
from shopstream.operators.silver import UNKNOWN
from shopstream.operators.state import GRAIN_SUMS, Partial

# Lower bounds of the purchase segments, best first.
PURCHASE_SEGMENTS = ((10, "Champion"), (5, "Loyal"), (2, "Potential Loyalist"), (1, "New Customer"))
ENGAGED_VIEWS = 10
# Score 5, 4, 3, 2 bounds; anything else scores 1.
RECENCY_DAYS = (7, 14, 30, 60)
FREQUENCY_SESSIONS = (20, 10, 5, 2)
MONETARY_REVENUE = (1000, 500, 100)
CHURN_DAYS = ((30, "High"), (14, "Medium"))

CORE = (
    "user_id",
    "total_sessions",
    "total_events",
    "total_views",
    "total_cart_adds",
    "total_purchases",
    "unique_products_viewed",
    "total_revenue",
    "avg_purchase_value",
    "first_activity_date",
    "last_activity_date",
    "unique_days_active",
    "view_to_cart_rate",
    "overall_conversion_rate",
    "customer_lifetime_value",
    "days_since_last_activity",
    "customer_segment",
)

# Hours fit in five bits: count and hour packed in one long pick the most frequent
# hour, the earliest on a tie, inside a fixed-width hash-aggregate buffer.
_HOURS = 32


def _activity_rows(silver: DataFrame) -> DataFrame:
    """Sums, amounts and times stand in the few rows of days; those of sessions and products, nearly as many as events, hold what they
    are counted by and nothing else, so that little of them is shuffled."""
    rows = typed(
        silver,
        ["user_id", "user_session", "product_id", "event_date", "event_hour", "event_time"],
        revenue=True,
    )
    counted = entity_grains(
        rows,
        ["user_id"],
        {"session": "user_session", "product": "product_id"},
        [F.sum("carts").alias("carts"), F.sum("purchases").alias("purchases")],
    )
    summed = entity_grains(
        rows,
        ["user_id"],
        {"date": "event_date", "hour": "event_hour"},
        [
            *type_sums(),
            F.sum("paid_units").alias("paid_units"),
            F.max("paid").alias("paid_max"),
            F.min("event_time").alias("t_min"),
            F.max("event_time").alias("t_max"),
        ],
    )
    return summed.unionByName(counted, allowMissingColumns=True)


def _activity_of(grains: DataFrame) -> DataFrame:
    day = of("date", "event_date")
    bought_day = of("date", "CASE WHEN purchases > 0 THEN event_date END")
    busiest = F.max(of("hour", f"n * {_HOURS} + ({_HOURS - 1} - event_hour)"))
    return grains.groupBy("user_id").agg(
        distinct_if("session", "user_session").alias("total_sessions"),
        total("date", "n").alias("total_events"),
        total("date", "views").alias("total_views"),
        total("date", "carts").alias("total_cart_adds"),
        total("date", "removes").alias("total_cart_removes"),
        total("date", "purchases").alias("total_purchases"),
        distinct_if("product", "product_id").alias("unique_products_viewed"),
        distinct_if("product", "product_id", "carts > 0").alias("unique_products_carted"),
        distinct_if("product", "product_id", "purchases > 0").alias(
            "unique_products_purchased"
        ),
        money(total("date", "paid_units")).alias("total_revenue"),
        F.max("paid_max").alias("max_purchase_value"),
        F.min("t_min").alias("first_activity_time"),
        F.max("t_max").alias("last_activity_time"),
        F.min(day).alias("first_activity_date"),
        F.max(day).alias("last_activity_date"),
        F.min(bought_day).alias("first_purchase_date"),
        F.max(bought_day).alias("last_purchase_date"),
        (_HOURS - 1 - busiest % _HOURS).cast("int").alias("most_active_hour"),
        distinct_if("date", "event_date").alias("unique_days_active"),
    )


def _favourite_rows(silver: DataFrame) -> DataFrame:
    return entity_grains(
        silver.select("user_id", "category_l1", "brand"),
        ["user_id"],
        {"category": "category_l1", "brand": "brand"},
        [],
    )


def _favourites_of(grains: DataFrame) -> DataFrame:
    def most_frequent(kind: str, column: str, condition: str) -> Column:
        hit = f"{ENTITY} = '{kind}' AND {condition}"
        return F.expr(
            f"min(CASE WHEN {hit} THEN named_struct('rank', -n, 'value', {column}) END).value"
        )

    return grains.groupBy("user_id").agg(
        distinct_if("category", "category_l1").alias("unique_categories_engaged"),
        distinct_if("brand", "brand").alias("unique_brands_engaged"),
        most_frequent("category", "category_l1", "category_l1 IS NOT NULL").alias("top_category"),
        most_frequent("brand", "brand", f"brand != '{UNKNOWN}'").alias("top_brand"),
    )


# Counts, revenue and dates per user.
ACTIVITY = Partial(
    _activity_rows, _activity_of, {**GRAIN_SUMS, "paid_units": "sum", "paid_max": "max", "t_min": "min", "t_max": "max"}
)
# Distinct and most frequent category and brand per user, lowest name on a tie. Reads none of the other's columns but
# the user, so the split costs no extra input and keeps text out of the other's buffers.
FAVOURITES = Partial(_favourite_rows, _favourites_of, {"n": "sum"})

AGGREGATE_COLUMNS = (
    "user_id",
    "total_sessions",
    "total_events",
    "total_views",
    "total_cart_adds",
    "total_cart_removes",
    "total_purchases",
    "unique_products_viewed",
    "unique_products_carted",
    "unique_products_purchased",
    "unique_categories_engaged",
    "unique_brands_engaged",
    "total_revenue",
    "avg_purchase_value",
    "max_purchase_value",
    "first_activity_time",
    "last_activity_time",
    "first_activity_date",
    "last_activity_date",
    "first_purchase_date",
    "last_purchase_date",
    "most_active_hour",
    "top_category",
    "top_brand",
    "unique_days_active",
)


def aggregate(silver: DataFrame) -> DataFrame:
    """One row per user with 24 aggregates.

    ``unique_products_viewed`` counts products of every event type: its name and value
    are kept as published.
    """
    return combine(ACTIVITY.apply(silver), FAVOURITES.apply(silver))


def combine(activity: DataFrame, favourites: DataFrame) -> DataFrame:
    """The aggregates from their two finished parts."""
    joined = activity.join(favourites, "user_id")
    paid = F.try_divide(F.col("total_revenue"), F.col("total_purchases").cast("double"))
    return joined.withColumn("avg_purchase_value", paid).select(*AGGREGATE_COLUMNS)


def as_of_date(silver: DataFrame, as_of: datetime.date | str | Column | None) -> Column:
    """The day recency is measured from: given, or the last day with an event."""
    if as_of is None:
        return silver.agg(F.max("event_date")).scalar()
    if isinstance(as_of, Column):
        return as_of
    return F.to_date(F.lit(str(as_of)))


def derive(customers: DataFrame, today: Column) -> DataFrame:
    """Rates, recency, scores, segment and churn risk from the aggregates."""
    segment = case_when(
        [
            *[(f"total_purchases >= {least}", name) for least, name in PURCHASE_SEGMENTS],
            ("total_cart_adds > 0", "Cart Abandoner"),
            (f"total_views > {ENGAGED_VIEWS}", "Engaged Browser"),
        ],
        "Visitor",
    )
    idle = "days_since_last_activity"
    scores = {
        "recency_score": [f"{idle} <= {days}" for days in RECENCY_DAYS],
        "frequency_score": [f"total_sessions >= {n}" for n in FREQUENCY_SESSIONS],
        "monetary_score": [*[f"total_revenue >= {r}" for r in MONETARY_REVENUE], "total_revenue > 0"],
    }
    churn = case_when(
        [("total_purchases <= 0", "N/A"), *[(f"{idle} > {d}", risk) for d, risk in CHURN_DAYS]], "Low"
    )
    with_dates = customers.withColumns(
        {
            "view_to_cart_rate": pct("total_cart_adds", "total_views"),
            "cart_to_purchase_rate": pct("total_purchases", "total_cart_adds"),
            "overall_conversion_rate": pct("total_purchases", "total_views"),
            "customer_lifetime_value": F.col("total_revenue"),
            "days_since_last_activity": F.datediff(today, "last_activity_date"),
            "days_since_last_purchase": F.datediff(today, "last_purchase_date"),
            "customer_tenure_days": F.expr("datediff(last_activity_date, first_activity_date)"),
            "avg_events_per_session": safe_ratio("total_events", "total_sessions"),
            "avg_events_per_day": ratio("total_events", "unique_days_active"),
            "customer_segment": segment,
        }
    )
    # The first bound that holds gives 5 points, the next 4 and so on; none gives 1.
    scored = with_dates.withColumns(
        {name: case_when(zip(bounds, (5, 4, 3, 2)), 1) for name, bounds in scores.items()}
    )
    return scored.withColumns({"rfm_score": F.expr(" + ".join(scores)), "churn_risk": churn})


def customer_metrics(
    silver: DataFrame,
    as_of: datetime.date | str | Column | None = None,
    columns: str = "full",
    audit: bool = False,
) -> DataFrame:
    """The customer gold table; ``columns="core"`` gives the compact pipeline variant.

    The compact variant has no "Engaged Browser" segment, such users are visitors.
    """
    today = as_of_date(silver, as_of)
    if columns == "core":
        activity = ACTIVITY.apply(silver).withColumn(
            "avg_purchase_value",
            F.try_divide(F.col("total_revenue"), F.col("total_purchases").cast("double")),
        )
        out = derive(activity, today).select(*CORE)
        plain = F.when(F.col("customer_segment") == "Engaged Browser", "Visitor")
        out = out.withColumn("customer_segment", plain.otherwise(F.col("customer_segment")))
    else:
        out = derive(aggregate(silver), today)
    return out.withColumn("processed_timestamp", F.current_timestamp()) if audit else out
