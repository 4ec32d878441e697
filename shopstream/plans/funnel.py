"""Conversion funnel per day and top category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.functions.numerics import money, money_ratio, pct, units
from shopstream.operators.grains import distinct_if, entity_grains, total, type_sums, typed
from shopstream.operators.state import GRAIN_SUMS, Partial

GRAIN = ("event_date", "category_l1")
CORE = (
    "event_date",
    "category_l1",
    "total_sessions",
    "sessions_with_view",
    "sessions_with_cart",
    "sessions_with_purchase",
    "total_revenue",
    "session_view_to_cart_rate",
    "session_cart_to_purchase_rate",
    "cart_abandonment_rate",
)

# Column names of the distinct counts: (entity, value column, all, viewed, carted, bought).
# The product count named "viewed" covers every event type, as published.
STAGES = (
    ("session", "user_session", "total_sessions", "sessions_with_view", "sessions_with_cart",
     "sessions_with_purchase"),
    ("user", "user_id", "total_users", "users_who_viewed", "users_who_carted",
     "users_who_purchased"),
    ("product", "product_id", "unique_products_viewed", None, "unique_products_carted",
     "unique_products_purchased"),
)
_REACHED = (None, "views", "carts", "purchases")

AGGREGATE_COLUMNS = (
    "event_date",
    "category_l1",
    "total_sessions",
    "sessions_with_view",
    "sessions_with_cart",
    "sessions_with_purchase",
    "total_users",
    "users_who_viewed",
    "users_who_carted",
    "users_who_purchased",
    "total_views",
    "total_cart_adds",
    "total_cart_removes",
    "total_purchases",
    "total_revenue",
    "unique_products_viewed",
    "unique_products_carted",
    "unique_products_purchased",
)


def aggregate(
    silver: DataFrame,
    by=GRAIN,
    strategy: str = "two_level",
    approx: float | None = None,
) -> DataFrame:
    """Sessions, users, products, events and revenue at each funnel stage.

    ``two_level`` copies a row once per entity (3 copies), ``expand`` is
    the literal list of eleven distinct counts (12 copies); both are exact.
    ``approx`` uses sketches of the given error instead.
    """
    names = _names()
    if approx is not None or strategy == "expand":
        return _direct(silver, by, approx).select(*by, *names)
    if strategy != "two_level":
        raise ValueError(f"unknown strategy {strategy!r}")
    return _stages_of(_grains(silver, by), by)


def _names() -> list[str]:
    return [c for c in AGGREGATE_COLUMNS if c not in GRAIN]


def _grains(silver: DataFrame, by=GRAIN) -> DataFrame:
    return entity_grains(
        typed(silver, [*by, "user_session", "user_id", "product_id"], revenue=True),
        by,
        {kind: column for kind, column, *_ in STAGES},
        [*type_sums(), F.sum("paid_units").alias("paid_units")],
    )


def _stages_of(grains: DataFrame, by=GRAIN) -> DataFrame:
    distincts = [
        distinct_if(kind, column, reached and f"{reached} > 0").alias(name)
        for kind, column, *stage_names in STAGES
        for reached, name in zip(_REACHED, stage_names)
        if name
    ]
    return (
        grains.groupBy(*by)
        .agg(
            *distincts,
            total("product", "views").alias("total_views"),
            total("product", "carts").alias("total_cart_adds"),
            total("product", "removes").alias("total_cart_removes"),
            total("product", "purchases").alias("total_purchases"),
            money(total("product", "paid_units")).alias("total_revenue"),
        )
        .select(*by, *_names())
    )


PARTIAL = Partial(_grains, _stages_of, {**GRAIN_SUMS, "paid_units": "sum"})


def _direct(silver: DataFrame, by, approx: float | None) -> DataFrame:
    kinds = dict(zip(_REACHED[1:], ("view", "cart", "purchase")))

    def distinct(column: str, reached: str | None):
        value = F.col(column)
        if reached is not None:
            value = F.when(F.col("event_type") == kinds[reached], value)
        return F.count_distinct(value) if approx is None else F.approx_count_distinct(value, approx)

    distincts = [
        distinct(column, reached).alias(name)
        for _, column, *stage_names in STAGES
        for reached, name in zip(_REACHED, stage_names)
        if name
    ]
    kind = F.col("event_type")
    return silver.groupBy(*by).agg(
        *distincts,
        F.count_if(kind == "view").alias("total_views"),
        F.count_if(kind == "cart").alias("total_cart_adds"),
        F.count_if(kind == "remove_from_cart").alias("total_cart_removes"),
        F.count_if(kind == "purchase").alias("total_purchases"),
        money(F.sum(F.when(kind == "purchase", units("price")).otherwise(0))).alias("total_revenue"),
    )


def derive(stages: DataFrame) -> DataFrame:
    """Stage-to-stage rates, drop-off and revenue per session.

    Purchases without a cart event make drop-offs negative and rates exceed 100; both are
    kept as they are.
    """
    dropped = {
        "view_dropoff": F.expr("sessions_with_view - sessions_with_cart"),
        "cart_dropoff": F.expr("sessions_with_cart - sessions_with_purchase"),
    }
    rates = {}
    for kind, seen, carted, bought in (
        ("session", "sessions_with_view", "sessions_with_cart", "sessions_with_purchase"),
        ("user", "users_who_viewed", "users_who_carted", "users_who_purchased"),
    ):
        rates[f"{kind}_view_to_cart_rate"] = pct(carted, seen)
        rates[f"{kind}_cart_to_purchase_rate"] = pct(bought, carted)
        rates[f"{kind}_overall_conversion_rate"] = pct(bought, seen)
    rates["event_view_to_cart_rate"] = pct("total_cart_adds", "total_views")
    rates["event_cart_to_purchase_rate"] = pct("total_purchases", "total_cart_adds")
    after = {
        "view_dropoff_rate": pct("view_dropoff", "sessions_with_view"),
        "cart_abandonment_rate": pct("cart_dropoff", "sessions_with_cart"),
        "net_cart_adds": F.expr("total_cart_adds - total_cart_removes"),
        "revenue_per_purchasing_session": money_ratio("total_revenue", "sessions_with_purchase"),
        "revenue_per_total_session": money_ratio("total_revenue", "total_sessions"),
        "product_view_to_cart_rate": pct("unique_products_carted", "unique_products_viewed"),
        "product_cart_to_purchase_rate": pct("unique_products_purchased", "unique_products_carted"),
        "view_stage_pct": F.lit(100.0),
        "cart_stage_pct": F.col("session_view_to_cart_rate"),
        "purchase_stage_pct": F.col("session_overall_conversion_rate"),
    }
    return stages.withColumns({**rates, **dropped}).withColumns(after)


def conversion_funnel(
    silver: DataFrame,
    columns: str = "full",
    strategy: str = "two_level",
    approx: float | None = None,
    audit: bool = False,
) -> DataFrame:
    """The funnel gold table; ``columns="core"`` is the compact variant."""
    if columns == "core":
        out = _sessions_only(silver)
    else:
        out = derive(aggregate(silver, strategy=strategy, approx=approx))
    return out.withColumn("processed_timestamp", F.current_timestamp()) if audit else out


def _sessions_only(silver: DataFrame) -> DataFrame:
    """The compact variant needs one entity, so one grouping and no copies at all."""
    per_session = (
        typed(silver, [*GRAIN, "user_session"], revenue=True)
        .groupBy(*GRAIN, "user_session")
        .agg(*type_sums(), F.sum("paid_units").alias("paid_units"))
    )
    known = F.col("user_session").isNotNull()
    stages = per_session.groupBy(*GRAIN).agg(
        F.count_if(known).alias("total_sessions"),
        F.count_if(known & F.expr("views > 0")).alias("sessions_with_view"),
        F.count_if(known & F.expr("carts > 0")).alias("sessions_with_cart"),
        F.count_if(known & F.expr("purchases > 0")).alias("sessions_with_purchase"),
        money(F.coalesce(F.sum("paid_units"), F.lit(0).cast("bigint"))).alias("total_revenue"),
    )
    gap = "sessions_with_cart - sessions_with_purchase"
    return stages.withColumns(
        {
            "session_view_to_cart_rate": pct("sessions_with_cart", "sessions_with_view"),
            "session_cart_to_purchase_rate": pct("sessions_with_purchase", "sessions_with_cart"),
            "cart_abandonment_rate": pct(gap, "sessions_with_cart"),
        }
    ).select(*CORE)
