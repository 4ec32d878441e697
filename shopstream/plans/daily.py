"""Daily sales: activity, revenue, day-over-day change and rolling figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstream.functions.numerics import (
    MONEY_UNITS,
    money,
    pct,
    rounded,
    safe_money_ratio,
    safe_ratio,
    units,
)
from shopstream.operators.grains import distinct_if, entity_grains, total, type_sums, typed
from shopstream.operators.state import GRAIN_SUMS, Partial

CORE = (
    "event_date",
    "total_events",
    "total_views",
    "total_cart_adds",
    "total_purchases",
    "unique_users",
    "unique_sessions",
    "unique_buyers",
    "total_revenue",
    "avg_order_value",
    "overall_conversion_rate",
    "buyer_rate",
)


def aggregate(silver: DataFrame, approx: float | None = None) -> DataFrame:
    """One row per day. ``approx`` swaps exact distinct counts for sketches of that error."""
    if approx is not None:
        return _calendar(_sketched(silver, approx))
    return PARTIAL.apply(silver)


def _grains(silver: DataFrame) -> DataFrame:
    rows = typed(
        silver,
        ["event_date", "user_session", "user_id", "product_id", "category_l1", "brand"],
        revenue=True,
    )
    return entity_grains(
        rows,
        ["event_date"],
        {
            "user": "user_id",
            "session": "user_session",
            "product": "product_id",
            "category": "category_l1",
            "brand": "brand",
        },
        [
            *type_sums(),
            F.sum("paid_units").alias("paid_units"),
            F.max("paid").alias("paid_max"),
        ],
    )


def _days_of(grains: DataFrame) -> DataFrame:
    sold = "purchases > 0"
    days = grains.groupBy("event_date").agg(
        total("brand", "n").alias("total_events"),
        total("brand", "views").alias("total_views"),
        total("brand", "carts").alias("total_cart_adds"),
        total("brand", "removes").alias("total_cart_removes"),
        total("brand", "purchases").alias("total_purchases"),
        distinct_if("user", "user_id").alias("unique_users"),
        distinct_if("session", "user_session").alias("unique_sessions"),
        distinct_if("user", "user_id", sold).alias("unique_buyers"),
        distinct_if("product", "product_id").alias("unique_products_interacted"),
        distinct_if("product", "product_id", sold).alias("unique_products_sold"),
        money(total("brand", "paid_units")).alias("total_revenue"),
        F.max("paid_max").alias("max_order_value"),
        distinct_if("category", "category_l1", sold).alias("categories_with_sales"),
        distinct_if("brand", "brand", sold).alias("brands_with_sales"),
    )
    return _calendar(days)


PARTIAL = Partial(_grains, _days_of, {**GRAIN_SUMS, "paid_units": "sum", "paid_max": "max"})


def _sketched(silver: DataFrame, error: float) -> DataFrame:
    """Same figures with approximate distinct counts: one small shuffle."""
    kind = F.col("event_type")
    bought = kind == "purchase"

    def distinct(c: str, only=None):
        return F.approx_count_distinct(c if only is None else F.when(only, F.col(c)), error)

    return silver.groupBy("event_date").agg(
        F.count("*").alias("total_events"),
        F.count_if(kind == "view").alias("total_views"),
        F.count_if(kind == "cart").alias("total_cart_adds"),
        F.count_if(kind == "remove_from_cart").alias("total_cart_removes"),
        F.count_if(bought).alias("total_purchases"),
        distinct("user_id").alias("unique_users"),
        distinct("user_session").alias("unique_sessions"),
        distinct("user_id", bought).alias("unique_buyers"),
        distinct("product_id").alias("unique_products_interacted"),
        distinct("product_id", bought).alias("unique_products_sold"),
        money(F.sum(F.when(bought, units("price")).otherwise(0))).alias("total_revenue"),
        F.max(F.when(bought, F.col("price"))).alias("max_order_value"),
        distinct("category_l1", bought).alias("categories_with_sales"),
        distinct("brand", bought).alias("brands_with_sales"),
    )


def _calendar(days: DataFrame) -> DataFrame:
    """Add calendar fields and the mean order value, and settle the column order."""
    d = F.col("event_date")
    order_value = F.try_divide(F.col("total_revenue"), F.col("total_purchases").cast("double"))
    return days.select(
        d,
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
        F.weekofyear(d).alias("week_of_year"),
        "total_events",
        "total_views",
        "total_cart_adds",
        "total_cart_removes",
        "total_purchases",
        "unique_users",
        "unique_sessions",
        "unique_buyers",
        "unique_products_interacted",
        "unique_products_sold",
        "total_revenue",
        order_value.alias("avg_order_value"),
        "max_order_value",
        "categories_with_sales",
        "brands_with_sales",
    )


def derive(days: DataFrame, frame: str = "rows") -> DataFrame:
    """Rates, change on the previous day and rolling figures.

    The windows see one row per calendar day (under 40,000 a century), so their single
    task is bounded by time, not by data. ``frame="rows"`` rolls over the last 7 or 30
    rows, ``frame="days"`` over that many calendar days, which differs where
    days are missing.
    """
    by_day = Window.orderBy("event_date")
    if frame == "days":
        number = Window.orderBy(F.unix_date("event_date"))
        week, month = number.rangeBetween(-6, 0), number.rangeBetween(-29, 0)
    else:
        week, month = by_day.rowsBetween(-6, 0), by_day.rowsBetween(-29, 0)
    revenue, users = F.col("total_revenue"), F.col("unique_users")
    # Rolling sums stay in whole money units so that they are exact.
    rolled_units = F.col("_units")

    return (
        days.withColumns(
            {
                "view_to_cart_rate": pct("total_cart_adds", "total_views"),
                "cart_to_purchase_rate": pct("total_purchases", "total_cart_adds"),
                "overall_conversion_rate": pct("total_purchases", "total_views"),
                "events_per_user": safe_ratio("total_events", "unique_users"),
                "events_per_session": safe_ratio("total_events", "unique_sessions"),
                "revenue_per_user": safe_money_ratio("total_revenue", "unique_users"),
                "buyer_rate": safe_ratio("unique_buyers * 100", "unique_users"),
                "_units": units(revenue),
            }
        )
        .withColumns(
            {
                "_before": F.lag("_units").over(by_day),
                "_users_before": F.lag("unique_users").over(by_day),
                "_rate_units": units("overall_conversion_rate"),
            }
        )
        .withColumns(
            {
                "revenue_dod_change": pct("_units - _before", "_before"),
                "users_dod_change": pct("unique_users - _users_before", "_users_before"),
                "revenue_7d_avg": _rolling_mean(rolled_units, week),
                "users_7d_avg": rounded(
                    F.sum(users).over(week).cast("double") / F.count("*").over(week)
                ),
                "conversion_7d_avg": _rolling_mean(F.col("_rate_units"), week),
                "revenue_30d_total": rounded(money(F.sum(rolled_units).over(month))),
                "is_weekend": F.col("day_of_week").isin(1, 7),
            }
        )
        .drop("_units", "_before", "_users_before", "_rate_units")
    )


def _rolling_mean(whole_units, frame):
    total = F.sum(whole_units).over(frame).cast("double")
    return rounded(total / (F.count("*").over(frame) * MONEY_UNITS))


def daily_sales_summary(
    silver: DataFrame,
    columns: str = "full",
    frame: str = "rows",
    approx: float | None = None,
    audit: bool = False,
) -> DataFrame:
    """The daily gold table in date order; ``columns="core"`` is the compact variant."""
    days = aggregate(silver, approx)
    if columns == "core":
        out = days.withColumns(
            {
                "overall_conversion_rate": pct("total_purchases", "total_views"),
                "buyer_rate": safe_ratio("unique_buyers * 100", "unique_users"),
            }
        ).select(*CORE)
    else:
        out = derive(days, frame)
    if audit:
        out = out.withColumn("processed_timestamp", F.current_timestamp())
    return out.orderBy("event_date")
