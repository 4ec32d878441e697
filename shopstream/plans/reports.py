"""Summary queries over silver and gold tables.

Every top-n ends its ordering with the key, so equal figures keep a fixed order.
Spark runs ordering and limit as one top-k: each task sends n rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.functions.numerics import MONEY_UNITS, money, pct, rounded, units
from shopstream.operators.silver import UNKNOWN


def _revenue(c: str = "total_revenue") -> Column:
    """Exact sum of an amount column; grand totals may pass the range of a whole number of units."""
    return F.sum(F.col(c).cast("decimal(38,4)")).cast("double")


def _mean_amount(c: str) -> Column:
    """Mean of an amount or rate column from its exact sum."""
    return F.try_divide(F.sum(units(c)).cast("double"), F.count(c).cast("double") * MONEY_UNITS)


def _mean_count(c: str) -> Column:
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


# silver

def event_type_distribution(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("event_type")
        .agg(F.count("*").alias("event_count"))
        .orderBy(F.desc("event_count"), "event_type")
    )


def date_range(events: DataFrame) -> DataFrame:
    """First and last event and the days between."""
    return events.agg(
        F.min("event_time").alias("min_date"), F.max("event_time").alias("max_date")
    ).withColumn("days_span", F.datediff("max_date", "min_date"))


def _top_values(events: DataFrame, column: str, n: int) -> DataFrame:
    return (
        events.groupBy(column)
        .agg(F.count("*").alias("event_count"))
        .orderBy(F.desc("event_count"), column)
        .limit(n)
    )


def top_categories(silver: DataFrame, n: int = 10) -> DataFrame:
    return _top_values(silver, "category_l1", n)


def top_brands(silver: DataFrame, n: int = 10) -> DataFrame:
    return _top_values(silver.filter(F.col("brand") != UNKNOWN), "brand", n)


def default_fill_counts(silver: DataFrame) -> DataFrame:
    """How often an absent brand or category was filled with the default."""
    return silver.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("brand") == UNKNOWN).alias("unknown_brands"),
        F.count_if(F.col("category_code") == UNKNOWN).alias("unknown_categories"),
    )


def events_between(silver: DataFrame, first: str, last: str) -> DataFrame:
    """Events of a closed range of days; prunes date partitions."""
    return silver.filter(F.col("event_date").between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))


def user_journey(silver: DataFrame, user_id: int) -> DataFrame:
    """One user's events in time order."""
    return silver.filter(F.col("user_id") == user_id).orderBy("event_time", "event_id")


def purchases_in_category(silver: DataFrame, category: str) -> DataFrame:
    return silver.filter((F.col("event_type") == "purchase") & (F.col("category_l1") == category))


def hourly_pattern(silver: DataFrame) -> DataFrame:
    """Events, purchases and revenue by hour of day."""
    bought = F.col("event_type") == "purchase"
    return (
        silver.groupBy("event_hour")
        .agg(
            F.count("*").alias("total_events"),
            F.count_if(bought).alias("total_purchases"),
            money(F.sum(F.when(bought, units("price")).otherwise(0))).alias("total_revenue"),
        )
        .orderBy("event_hour")
    )


# customers

def top_customers(customers: DataFrame, n: int = 10) -> DataFrame:
    return (
        customers.select(
            "user_id",
            "customer_lifetime_value",
            "total_purchases",
            "customer_segment",
            "rfm_score",
            "churn_risk",
        )
        .orderBy(F.desc("customer_lifetime_value"), "user_id")
        .limit(n)
    )


def segment_distribution(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("customer_segment")
        .agg(
            F.count("*").alias("customer_count"),
            rounded(_mean_amount("total_revenue")).alias("avg_revenue"),
            rounded(_mean_count("total_purchases")).alias("avg_purchases"),
        )
        .orderBy(F.desc("customer_count"), "customer_segment")
    )


def customer_summary(customers: DataFrame) -> DataFrame:
    return customers.agg(
        F.count("*").alias("total_customers"),
        _revenue().alias("total_revenue"),
        _mean_amount("total_revenue").alias("avg_clv"),
        _mean_count("total_purchases").alias("avg_purchases"),
        F.count_if(F.col("churn_risk") == "High").alias("high_churn_risk"),
    )


# products

def top_products(products: DataFrame, n: int = 10) -> DataFrame:
    return (
        products.select(
            "product_id",
            "brand",
            "category_l1",
            "total_revenue",
            "total_purchases",
            "overall_conversion_rate",
            "performance_tier",
        )
        .orderBy(F.desc("total_revenue"), "product_id")
        .limit(n)
    )


def _product_groups(products: DataFrame, column: str, n: int, *more: Column) -> DataFrame:
    return (
        products.groupBy(column)
        .agg(
            F.count("*").alias("product_count"),
            rounded(_revenue()).alias("total_revenue"),
            rounded(_mean_amount("overall_conversion_rate")).alias("avg_conversion_rate"),
            *more,
        )
        .orderBy(F.desc("total_revenue"), column)
        .limit(n)
    )


def revenue_by_category(products: DataFrame, n: int = 15) -> DataFrame:
    return _product_groups(products, "category_l1", n, F.sum("total_views").alias("total_views"))


def revenue_by_brand(products: DataFrame, n: int = 10) -> DataFrame:
    return _product_groups(products.filter(F.col("brand") != UNKNOWN), "brand", n)


def product_summary(products: DataFrame) -> DataFrame:
    return products.agg(
        F.count("*").alias("total_products"),
        _revenue().alias("total_revenue"),
        rounded(_mean_amount("overall_conversion_rate")).alias("avg_conversion_rate"),
        F.sum("total_purchases").alias("total_purchases"),
    )


# days

def revenue_trend(days: DataFrame, n: int = 30) -> DataFrame:
    """The last n days, newest first."""
    return (
        days.select(
            "event_date",
            "day_name",
            "total_revenue",
            "revenue_dod_change",
            "revenue_7d_avg",
            "unique_users",
            "total_purchases",
        )
        .orderBy(F.desc("event_date"))
        .limit(n)
    )


def day_of_week(days: DataFrame) -> DataFrame:
    return (
        days.groupBy("day_name", "day_of_week")
        .agg(
            F.count("*").alias("num_days"),
            rounded(_mean_amount("total_revenue")).alias("avg_revenue"),
            rounded(_mean_count("unique_users")).alias("avg_users"),
            rounded(_mean_amount("overall_conversion_rate")).alias("avg_conversion_rate"),
        )
        .orderBy("day_of_week")
    )


def daily_summary(days: DataFrame) -> DataFrame:
    return days.agg(
        F.count("*").alias("total_days"),
        _revenue().alias("total_revenue"),
        rounded(_mean_amount("total_revenue")).alias("avg_daily_revenue"),
        rounded(_mean_count("unique_users")).alias("avg_daily_users"),
        rounded(_mean_amount("overall_conversion_rate")).alias("avg_conversion_rate"),
    )


# funnel

def latest_funnel(funnel: DataFrame, n: int = 20) -> DataFrame:
    """Newest days first, busiest categories first within a day."""
    return (
        funnel.orderBy(F.desc("event_date"), F.desc("total_sessions"), "category_l1")
        .select(
            "event_date",
            "category_l1",
            "sessions_with_view",
            "sessions_with_cart",
            "sessions_with_purchase",
            "session_view_to_cart_rate",
            "session_cart_to_purchase_rate",
            "cart_abandonment_rate",
        )
        .limit(n)
    )


def overall_funnel(funnel: DataFrame) -> DataFrame:
    """Stage totals and the ratios between them."""
    return funnel.agg(
        F.sum("sessions_with_view").alias("total_view_sessions"),
        F.sum("sessions_with_cart").alias("total_cart_sessions"),
        F.sum("sessions_with_purchase").alias("total_purchase_sessions"),
        _revenue().alias("total_revenue"),
    ).withColumns(
        {
            "overall_view_to_cart_rate": pct("total_cart_sessions", "total_view_sessions"),
            "overall_cart_to_purchase_rate": pct("total_purchase_sessions", "total_cart_sessions"),
            "overall_conversion_rate": pct("total_purchase_sessions", "total_view_sessions"),
        }
    )


def funnel_by_category(funnel: DataFrame, n: int = 15) -> DataFrame:
    return (
        funnel.groupBy("category_l1")
        .agg(
            F.sum("sessions_with_view").alias("view_sessions"),
            F.sum("sessions_with_cart").alias("cart_sessions"),
            F.sum("sessions_with_purchase").alias("purchase_sessions"),
            rounded(_mean_amount("session_view_to_cart_rate")).alias("avg_view_to_cart"),
            rounded(_mean_amount("session_cart_to_purchase_rate")).alias("avg_cart_to_purchase"),
            rounded(_mean_amount("cart_abandonment_rate")).alias("avg_cart_abandonment"),
            _revenue().alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "category_l1")
        .limit(n)
    )


def cart_abandonment(funnel: DataFrame, min_sessions: int = 100, n: int = 10) -> DataFrame:
    """Categories that lose most carts, among those with more than ``min_sessions``."""
    return (
        funnel.groupBy("category_l1")
        .agg(
            F.sum("sessions_with_cart").alias("total_cart_sessions"),
            F.sum("cart_dropoff").alias("total_cart_abandonments"),
            rounded(_mean_amount("cart_abandonment_rate")).alias("avg_abandonment_rate"),
        )
        .filter(F.col("total_cart_sessions") > min_sessions)
        .orderBy(F.desc("avg_abandonment_rate"), "category_l1")
        .limit(n)
    )


def funnel_summary(funnel: DataFrame) -> DataFrame:
    return funnel.agg(
        F.sum("sessions_with_view").alias("total_view_sessions"),
        F.sum("sessions_with_purchase").alias("total_purchase_sessions"),
        rounded(_mean_amount("cart_abandonment_rate")).alias("avg_cart_abandonment"),
        _revenue().alias("total_revenue"),
    ).withColumn("overall_conversion", pct("total_purchase_sessions", "total_view_sessions"))
