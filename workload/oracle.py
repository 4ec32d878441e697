"""SQL for DuckDB that computes the same results from the same tables.

Written independently of the Spark plans: one literal ``count(DISTINCT ...)`` per figure,
plain windows for ranks, decimals for money.
"""

from __future__ import annotations

import re

from workload.queries import (
    AS_OF,
    CATEGORY,
    DAY_RANGE,
    DELIVERIES,
    GRANTS,
    JOURNEY_USER,
    LAST_LOAD_DAY,
    ORDERS_AS_OF,
    SEGMENT_USER,
)

TYPES = "('view', 'cart', 'remove_from_cart', 'purchase')"
VALID = (
    f"event_time IS NOT NULL AND event_type IN {TYPES} AND product_id > 0 AND user_id > 0 "
    "AND price BETWEEN 0 AND 100000"
)
INVALID = f"NOT coalesce({VALID}, false)"
RAW = "event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session"
DERIVED = (
    "event_date, event_hour, event_day_of_week, event_day_of_month, event_month, event_year, "
    "event_week, category_l1, category_l2, category_l3"
)
SILVER = f"event_id, {RAW}, {DERIVED}"


def rnd(value: str, scale: int = 2) -> str:
    """Half-up rounding of a double's shortest decimal form, once."""
    return f"CAST(ROUND(CAST(CAST(CAST({value} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,15)), {scale}) AS DOUBLE)"


def ratio(num: str, den: str, scale: int = 2) -> str:
    return rnd(f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / {den} ELSE 0 END", scale)


def pct(num: str, den: str) -> str:
    return ratio(f"({num}) * 100", den)


def in_units(value: str) -> str:
    """An amount as a whole number of ten-thousandths."""
    return f"CAST(ROUND({value} * 10000) AS BIGINT)"


def money_ratio(amount: str, den: str, scale: int = 2) -> str:
    return ratio(in_units(amount), f"({den} * 10000)", scale)


def total(value: str) -> str:
    """Exact sum of amounts."""
    return f"CAST(coalesce(sum(CAST({value} AS DECIMAL(18,4))), 0) AS DOUBLE)"


def mean_money(value: str) -> str:
    """Mean of an amount that is not rounded afterwards: the amount in units of money, divided once."""
    return f"CAST(sum(CAST({value} AS DECIMAL(18,4))) AS DOUBLE) / count({value})"


def mean(value: str) -> str:
    return f"CAST(sum({in_units(value)}) AS DOUBLE) / (count({value}) * 10000)"


def only(kind: str) -> str:
    return f"FILTER (event_type = '{kind}')"


def standardized(source: str) -> str:
    return f"""
      SELECT event_time, lower(trim(event_type)) AS event_type, product_id, category_id,
        coalesce(nullif(trim(category_code), ''), 'unknown') AS category_code,
        lower(coalesce(nullif(trim(brand), ''), 'unknown')) AS brand, price, user_id,
        trim(user_session) AS user_session, ingestion_timestamp, source_file
      FROM {source}"""


def derived(source: str) -> str:
    return f"""
      SELECT sha256(concat(CAST(event_time AS VARCHAR), user_id, product_id,
          coalesce(user_session, ''), event_type)) AS event_id, {RAW},
        CAST(event_time AS DATE) AS event_date,
        CAST(hour(event_time) AS INTEGER) AS event_hour,
        CAST(dayofweek(event_time) + 1 AS INTEGER) AS event_day_of_week,
        CAST(day(event_time) AS INTEGER) AS event_day_of_month,
        CAST(month(event_time) AS INTEGER) AS event_month,
        CAST(year(event_time) AS INTEGER) AS event_year,
        CAST(weekofyear(event_time) AS INTEGER) AS event_week,
        string_split(category_code, '.')[1] AS category_l1,
        string_split(category_code, '.')[2] AS category_l2,
        string_split(category_code, '.')[3] AS category_l3,
        source_file, ingestion_timestamp
      FROM {source}"""


def unique(source: str) -> str:
    return f"""
      SELECT * FROM {source} QUALIFY row_number() OVER (
        PARTITION BY event_time, user_id, product_id, coalesce(user_session, ''), event_type
        ORDER BY ingestion_timestamp, source_file, category_id NULLS FIRST, category_code, brand,
          price) = 1"""


def favourite(silver: str, column: str, name: str, where: str) -> str:
    return f"""
      SELECT user_id, {column} AS {name} FROM (
        SELECT user_id, {column}, count(*) AS n FROM {silver} WHERE {where} GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, {column}) = 1"""


def customer_agg(silver: str) -> str:
    return f"""
      SELECT a.*, h.most_active_hour, c.top_category, b.top_brand FROM (
        SELECT user_id,
          count(DISTINCT user_session) AS total_sessions,
          count(*) AS total_events,
          count(*) {only('view')} AS total_views,
          count(*) {only('cart')} AS total_cart_adds,
          count(*) {only('remove_from_cart')} AS total_cart_removes,
          count(*) {only('purchase')} AS total_purchases,
          count(DISTINCT product_id) AS unique_products_viewed,
          count(DISTINCT product_id) {only('cart')} AS unique_products_carted,
          count(DISTINCT product_id) {only('purchase')} AS unique_products_purchased,
          count(DISTINCT category_l1) AS unique_categories_engaged,
          count(DISTINCT brand) AS unique_brands_engaged,
          {total("CASE WHEN event_type = 'purchase' THEN price END")} AS total_revenue,
          {mean_money("CASE WHEN event_type = 'purchase' THEN price END")} AS avg_purchase_value,
          max(price) {only('purchase')} AS max_purchase_value,
          min(event_time) AS first_activity_time, max(event_time) AS last_activity_time,
          min(event_date) AS first_activity_date, max(event_date) AS last_activity_date,
          min(event_date) {only('purchase')} AS first_purchase_date,
          max(event_date) {only('purchase')} AS last_purchase_date,
          count(DISTINCT event_date) AS unique_days_active
        FROM {silver} GROUP BY user_id) a
      LEFT JOIN ({favourite(silver, 'event_hour', 'most_active_hour', 'true')}) h USING (user_id)
      LEFT JOIN ({favourite(silver, 'category_l1', 'top_category', 'true')}) c USING (user_id)
      LEFT JOIN ({favourite(silver, 'brand', 'top_brand', "brand <> 'unknown'")}) b USING (user_id)"""


def customer_derived(agg: str, today: str) -> str:
    return f"""
      SELECT *, CAST(recency_score + frequency_score + monetary_score AS INTEGER) AS rfm_score FROM (
        SELECT *,
          {pct('total_cart_adds', 'total_views')} AS view_to_cart_rate,
          {pct('total_purchases', 'total_cart_adds')} AS cart_to_purchase_rate,
          {pct('total_purchases', 'total_views')} AS overall_conversion_rate,
          total_revenue AS customer_lifetime_value,
          CAST(date_diff('day', last_activity_date, {today}) AS INTEGER) AS days_since_last_activity,
          CAST(date_diff('day', last_purchase_date, {today}) AS INTEGER) AS days_since_last_purchase,
          CAST(date_diff('day', first_activity_date, last_activity_date) AS INTEGER)
            AS customer_tenure_days,
          {rnd('CAST(total_events AS DOUBLE) / nullif(total_sessions, 0)')} AS avg_events_per_session,
          {ratio('total_events', 'unique_days_active')} AS avg_events_per_day,
          CASE WHEN total_purchases >= 10 THEN 'Champion' WHEN total_purchases >= 5 THEN 'Loyal'
            WHEN total_purchases >= 2 THEN 'Potential Loyalist'
            WHEN total_purchases = 1 THEN 'New Customer'
            WHEN total_cart_adds > 0 THEN 'Cart Abandoner'
            WHEN total_views > 10 THEN 'Engaged Browser' ELSE 'Visitor' END AS customer_segment,
          CAST(CASE WHEN days_since_last_activity <= 7 THEN 5 WHEN days_since_last_activity <= 14 THEN 4
            WHEN days_since_last_activity <= 30 THEN 3 WHEN days_since_last_activity <= 60 THEN 2
            ELSE 1 END AS INTEGER) AS recency_score,
          CAST(CASE WHEN total_sessions >= 20 THEN 5 WHEN total_sessions >= 10 THEN 4
            WHEN total_sessions >= 5 THEN 3 WHEN total_sessions >= 2 THEN 2 ELSE 1 END AS INTEGER)
            AS frequency_score,
          CAST(CASE WHEN total_revenue >= 1000 THEN 5 WHEN total_revenue >= 500 THEN 4
            WHEN total_revenue >= 100 THEN 3 WHEN total_revenue > 0 THEN 2 ELSE 1 END AS INTEGER)
            AS monetary_score,
          CASE WHEN total_purchases > 0 AND days_since_last_activity > 30 THEN 'High'
            WHEN total_purchases > 0 AND days_since_last_activity > 14 THEN 'Medium'
            WHEN total_purchases > 0 THEN 'Low' ELSE 'N/A' END AS churn_risk
        FROM {agg})"""


def product_agg(silver: str) -> str:
    return f"""
      SELECT a.*, f.category_id, f.category_code, f.category_l1, f.category_l2, f.category_l3, f.brand,
        l.current_price
      FROM (
        SELECT product_id,
          {rnd(mean('price'))} AS avg_price, min(price) AS min_price, max(price) AS max_price,
          count(*) AS total_events,
          count(*) {only('view')} AS total_views,
          count(*) {only('cart')} AS total_cart_adds,
          count(*) {only('remove_from_cart')} AS total_cart_removes,
          count(*) {only('purchase')} AS total_purchases,
          count(DISTINCT user_id) AS unique_users_total,
          count(DISTINCT user_id) {only('view')} AS unique_users_viewed,
          count(DISTINCT user_id) {only('cart')} AS unique_users_carted,
          count(DISTINCT user_id) {only('purchase')} AS unique_users_purchased,
          count(DISTINCT user_session) AS unique_sessions,
          {total("CASE WHEN event_type = 'purchase' THEN price END")} AS total_revenue,
          min(event_date) AS first_seen_date, max(event_date) AS last_seen_date,
          count(DISTINCT event_date) AS days_with_activity
        FROM {silver} GROUP BY product_id) a
      JOIN (SELECT * FROM {silver} QUALIFY row_number() OVER (PARTITION BY product_id
        ORDER BY event_time, category_id NULLS FIRST, category_code, brand) = 1) f USING (product_id)
      JOIN (SELECT product_id, price AS current_price FROM {silver} QUALIFY row_number() OVER (
        PARTITION BY product_id ORDER BY event_time DESC, price DESC) = 1) l USING (product_id)"""


def product_derived(agg: str) -> str:
    return f"""
      SELECT *,
        {pct('total_cart_adds', 'total_views')} AS view_to_cart_rate,
        {pct('total_purchases', 'total_cart_adds')} AS cart_to_purchase_rate,
        {pct('total_purchases', 'total_views')} AS overall_conversion_rate,
        {pct('total_cart_adds - total_purchases', 'total_cart_adds')} AS cart_abandonment_rate,
        {money_ratio('total_revenue', 'total_views', 4)} AS revenue_per_view,
        {ratio('total_views', 'unique_sessions')} AS views_per_session,
        {pct('unique_users_purchased', 'unique_users_viewed')} AS purchase_user_ratio,
        {ratio('total_purchases', 'unique_users_purchased')} AS avg_purchases_per_buyer
      FROM {agg}"""


def product_ranked(rows: str) -> str:
    return f"""
      SELECT *,
        CASE WHEN revenue_percentile >= 90 THEN 'Top 10%' WHEN revenue_percentile >= 75 THEN 'Top 25%'
          WHEN revenue_percentile >= 50 THEN 'Top 50%' WHEN revenue_percentile >= 25 THEN 'Bottom 50%'
          ELSE 'Bottom 25%' END AS performance_tier,
        {rnd('total_views * 0.2 + total_cart_adds * 0.3 + total_purchases * 0.5')} AS popularity_score
      FROM (SELECT *,
        CAST(dense_rank() OVER (ORDER BY total_revenue DESC) AS INTEGER) AS revenue_rank_global,
        {rnd('percent_rank() OVER (ORDER BY total_revenue) * 100')} AS revenue_percentile,
        CAST(dense_rank() OVER (PARTITION BY category_l1 ORDER BY total_revenue DESC) AS INTEGER)
          AS revenue_rank_in_category,
        CAST(dense_rank() OVER (PARTITION BY brand ORDER BY total_revenue DESC) AS INTEGER)
          AS revenue_rank_in_brand
        FROM {rows})"""


def daily_agg(silver: str) -> str:
    return f"""
      SELECT event_date,
        CAST(dayofweek(event_date) + 1 AS INTEGER) AS day_of_week, dayname(event_date) AS day_name,
        CAST(month(event_date) AS INTEGER) AS "month", CAST(year(event_date) AS INTEGER) AS "year",
        CAST(weekofyear(event_date) AS INTEGER) AS week_of_year,
        count(*) AS total_events,
        count(*) {only('view')} AS total_views,
        count(*) {only('cart')} AS total_cart_adds,
        count(*) {only('remove_from_cart')} AS total_cart_removes,
        count(*) {only('purchase')} AS total_purchases,
        count(DISTINCT user_id) AS unique_users,
        count(DISTINCT user_session) AS unique_sessions,
        count(DISTINCT user_id) {only('purchase')} AS unique_buyers,
        count(DISTINCT product_id) AS unique_products_interacted,
        count(DISTINCT product_id) {only('purchase')} AS unique_products_sold,
        {total("CASE WHEN event_type = 'purchase' THEN price END")} AS total_revenue,
        {mean_money("CASE WHEN event_type = 'purchase' THEN price END")} AS avg_order_value,
        max(price) {only('purchase')} AS max_order_value,
        count(DISTINCT category_l1) {only('purchase')} AS categories_with_sales,
        count(DISTINCT brand) {only('purchase')} AS brands_with_sales
      FROM {silver} GROUP BY event_date"""


def daily_derived(agg: str, week: str, month: str) -> str:
    revenue = in_units("total_revenue")
    return f"""
      SELECT * EXCLUDE (before, users_before, rate),
        {pct(f'{revenue} - before', 'before')} AS revenue_dod_change,
        {pct('unique_users - users_before', 'users_before')} AS users_dod_change,
        {rnd(f'CAST(sum({revenue}) OVER w AS DOUBLE) / (count(*) OVER w * 10000)')} AS revenue_7d_avg,
        {rnd('CAST(sum(unique_users) OVER w AS DOUBLE) / count(*) OVER w')} AS users_7d_avg,
        {rnd('CAST(sum(rate) OVER w AS DOUBLE) / (count(*) OVER w * 10000)')} AS conversion_7d_avg,
        {rnd(f'CAST(sum({revenue}) OVER m AS DOUBLE) / 10000')} AS revenue_30d_total,
        day_of_week IN (1, 7) AS is_weekend
      FROM (SELECT *,
          {pct('total_cart_adds', 'total_views')} AS view_to_cart_rate,
          {pct('total_purchases', 'total_cart_adds')} AS cart_to_purchase_rate,
          {pct('total_purchases', 'total_views')} AS overall_conversion_rate,
          {in_units(pct('total_purchases', 'total_views'))} AS rate,
          {rnd('CAST(total_events AS DOUBLE) / unique_users')} AS events_per_user,
          {rnd('CAST(total_events AS DOUBLE) / unique_sessions')} AS events_per_session,
          {rnd(f'CAST({revenue} AS DOUBLE) / (unique_users * 10000)')} AS revenue_per_user,
          {rnd('unique_buyers * 100.0 / unique_users')} AS buyer_rate,
          lag({revenue}) OVER (ORDER BY event_date) AS before,
          lag(unique_users) OVER (ORDER BY event_date) AS users_before
        FROM {agg})
      WINDOW w AS (ORDER BY event_date {week}), m AS (ORDER BY event_date {month})"""


ROWS = ("ROWS BETWEEN 6 PRECEDING AND CURRENT ROW", "ROWS BETWEEN 29 PRECEDING AND CURRENT ROW")
CALENDAR = (
    "RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW",
    "RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW",
)


def funnel_agg(silver: str) -> str:
    distincts = []
    for column, everyone, names in (
        ("user_session", "total_sessions",
         ("sessions_with_view", "sessions_with_cart", "sessions_with_purchase")),
        ("user_id", "total_users", ("users_who_viewed", "users_who_carted", "users_who_purchased")),
        ("product_id", "unique_products_viewed",
         (None, "unique_products_carted", "unique_products_purchased")),
    ):
        distincts.append(f"count(DISTINCT {column}) AS {everyone}")
        for kind, name in zip(("view", "cart", "purchase"), names):
            if name:
                distincts.append(f"count(DISTINCT {column}) {only(kind)} AS {name}")
    return f"""
      SELECT event_date, category_l1, {', '.join(distincts)},
        count(*) {only('view')} AS total_views,
        count(*) {only('cart')} AS total_cart_adds,
        count(*) {only('remove_from_cart')} AS total_cart_removes,
        count(*) {only('purchase')} AS total_purchases,
        {total("CASE WHEN event_type = 'purchase' THEN price END")} AS total_revenue
      FROM {silver} GROUP BY event_date, category_l1"""


def funnel_derived(agg: str) -> str:
    return f"""
      SELECT *,
        {pct('sessions_with_cart', 'sessions_with_view')} AS session_view_to_cart_rate,
        {pct('sessions_with_purchase', 'sessions_with_cart')} AS session_cart_to_purchase_rate,
        {pct('sessions_with_purchase', 'sessions_with_view')} AS session_overall_conversion_rate,
        {pct('users_who_carted', 'users_who_viewed')} AS user_view_to_cart_rate,
        {pct('users_who_purchased', 'users_who_carted')} AS user_cart_to_purchase_rate,
        {pct('users_who_purchased', 'users_who_viewed')} AS user_overall_conversion_rate,
        {pct('total_cart_adds', 'total_views')} AS event_view_to_cart_rate,
        {pct('total_purchases', 'total_cart_adds')} AS event_cart_to_purchase_rate,
        sessions_with_view - sessions_with_cart AS view_dropoff,
        sessions_with_cart - sessions_with_purchase AS cart_dropoff,
        {pct('sessions_with_view - sessions_with_cart', 'sessions_with_view')} AS view_dropoff_rate,
        {pct('sessions_with_cart - sessions_with_purchase', 'sessions_with_cart')}
          AS cart_abandonment_rate,
        total_cart_adds - total_cart_removes AS net_cart_adds,
        {money_ratio('total_revenue', 'sessions_with_purchase')} AS revenue_per_purchasing_session,
        {money_ratio('total_revenue', 'total_sessions')} AS revenue_per_total_session,
        {pct('unique_products_carted', 'unique_products_viewed')} AS product_view_to_cart_rate,
        {pct('unique_products_purchased', 'unique_products_carted')} AS product_cart_to_purchase_rate,
        CAST(100.0 AS DOUBLE) AS view_stage_pct,
        {pct('sessions_with_cart', 'sessions_with_view')} AS cart_stage_pct,
        {pct('sessions_with_purchase', 'sessions_with_view')} AS purchase_stage_pct
      FROM {agg}"""


# Named steps; each may use any of the others.
CTES = {
    "delivered": """
      SELECT ts AS event_time,
        CASE event_type WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'remove_from_cart'
          ELSE event_type END AS event_type,
        CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS product_id,
        "value" AS price, user_id,
        concat('u', user_id, '-', CAST(CAST(ts AS DATE) AS VARCHAR)) AS user_session
      FROM events""",
    "copies": """
      SELECT *, event_time + INTERVAL 1 HOUR AS ingestion_timestamp, 'feed/first.csv' AS source_file
      FROM delivered
      UNION ALL
      SELECT * REPLACE (upper(event_type) AS event_type), event_time + INTERVAL 25 HOUR,
        'feed/again.csv' FROM delivered WHERE event_type = 'purchase'""",
    "bronze": """
      SELECT event_time, event_type, product_id, CAST(p_size AS BIGINT) AS category_id,
        CASE WHEN p_size > 5 THEN ' ' || lower(p_type) || '.' || replace(p_name, ' ', '.') || ' ' END
          AS category_code,
        CASE WHEN p_brand <> 'Brand#1' THEN ' ' || p_brand END AS brand,
        price, user_id, user_session, ingestion_timestamp, source_file,
        ingestion_timestamp AS created_at
      FROM copies LEFT JOIN part ON p_partkey = product_id""",
    "standard": standardized("bronze"),
    "valid": f"SELECT * FROM standard WHERE {VALID}",
    "kept": unique("valid"),
    "repeated": derived("valid"),
    "silver": derived("kept"),
    "orders_bronze": """
      SELECT l_shipdate AS event_time,
        CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'purchase'
          WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'remove_from_cart'
          WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'cart' ELSE 'view' END AS event_type,
        l_partkey + 1 AS product_id, CAST(p_size AS BIGINT) AS category_id,
        lower(p_type) || '.' || replace(p_name, ' ', '.') AS category_code, p_brand AS brand,
        l_extendedprice AS price, o_custkey + 1 AS user_id,
        CAST(l_orderkey AS VARCHAR) AS user_session,
        l_shipdate + INTERVAL 1 HOUR AS ingestion_timestamp, 'feed/orders.csv' AS source_file,
        l_shipdate + INTERVAL 1 HOUR AS created_at
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey""",
    "orders_standard": standardized("orders_bronze"),
    "orders_valid": f"SELECT * FROM orders_standard WHERE {VALID}",
    "orders_kept": unique("orders_valid"),
    "orders_silver": derived("orders_kept"),
    "all_bronze": "SELECT * FROM bronze UNION ALL BY NAME SELECT * FROM orders_bronze",
    # What the CSV files hold: whole seconds, no surrounding blanks.
    "csv_bronze": """
      SELECT date_trunc('second', event_time) AS event_time, trim(event_type) AS event_type, product_id,
        category_id, trim(category_code) AS category_code, trim(brand) AS brand, price, user_id,
        trim(user_session) AS user_session, TIMESTAMP '2024-01-01' AS ingestion_timestamp,
        'csv' AS source_file
      FROM bronze""",
    "csv_standard": standardized("csv_bronze"),
    "csv_valid": f"SELECT * FROM csv_standard WHERE {VALID}",
    "csv_kept": unique("csv_valid"),
    "csv_silver": derived("csv_kept"),
    "customer_agg": customer_agg("silver"),
    "customer_dated": """
      SELECT *, (SELECT max(event_date) FROM silver) AS today FROM customer_agg""",
    "customers": customer_derived("customer_agg", f"DATE '{AS_OF}'"),
    "product_agg": product_agg("silver"),
    "product_derived": product_derived("product_agg"),
    "products": product_ranked("product_derived"),
    "daily_agg": daily_agg("silver"),
    "days": daily_derived("daily_agg", *ROWS),
    "funnel_agg": funnel_agg("silver"),
    "funnel": funnel_derived("funnel_agg"),
    "access": "SELECT * FROM (VALUES "
    + ", ".join(
        "(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v).lower() for v in g) + ")"
        for g in GRANTS
    )
    + ") t(user_name, customer_segment, category_l1, is_admin)",
    "old_rows": f"SELECT * FROM silver WHERE event_date <= DATE '{LAST_LOAD_DAY}'",
    "batch": f"""
      SELECT * REPLACE (price + 1.0 AS price) FROM silver
      WHERE event_date >= DATE '{LAST_LOAD_DAY}' - 3""",
    "products_dim": """
      SELECT product_id, category_id, category_code, brand, price, category_l1 FROM silver QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY event_time DESC,
        category_id DESC NULLS LAST, category_code DESC, brand DESC, price DESC) = 1""",
}


def _needs(sql: str, seen: list[str]) -> None:
    for name in CTES:
        if name not in seen and re.search(rf"\b(?:FROM|JOIN|from|join)\s+{name}\b", sql):
            _needs(CTES[name], seen)
            if name not in seen:
                seen.append(name)


def query(sql: str) -> str:
    """Put the steps a statement refers to in front of it."""
    steps: list[str] = []
    _needs(sql, steps)
    if not steps:
        return sql
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in steps) + "\n" + sql


def _flags(columns) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in columns) + ")"


REQUIRED = ("event_time", "event_type", "product_id", "user_id", "price")
RULES = {
    "valid_event_time": "event_time IS NOT NULL",
    "valid_event_type": "event_type IS NOT NULL",
    "valid_product_id": "product_id IS NOT NULL",
    "valid_user_id": "user_id IS NOT NULL",
    "valid_price": "price IS NOT NULL",
    "event_type_in_allowed_values": f"event_type IN {TYPES}",
    "price_is_positive": "price >= 0",
    "price_within_range": "price <= 100000",
    "product_id_is_positive": "product_id > 0",
    "user_id_is_positive": "user_id > 0",
    "category_id_is_positive": "category_id IS NULL OR category_id > 0",
}
REASON = f"""CASE WHEN event_time IS NULL THEN 'null_event_time'
  WHEN event_type IS NULL THEN 'null_event_type' WHEN product_id IS NULL THEN 'null_product_id'
  WHEN user_id IS NULL THEN 'null_user_id' WHEN price IS NULL THEN 'null_price'
  WHEN price < 0 THEN 'negative_price' WHEN price > 100000 THEN 'price_above_max'
  WHEN lower(trim(event_type)) NOT IN {TYPES} THEN 'invalid_event_type'
  WHEN product_id <= 0 OR user_id <= 0 THEN 'non_positive_id' ELSE 'other' END"""
REJECTED = INVALID.replace("event_type IN", "lower(trim(event_type)) IN")
BRONZE_COLUMNS = f"{RAW}, ingestion_timestamp, source_file, created_at".split(", ")
CUSTOMER_PUBLIC = (
    "total_sessions, total_events, total_views, total_cart_adds, total_purchases, "
    "customer_lifetime_value, customer_segment, rfm_score, churn_risk"
)
BAND = """CASE WHEN price IS NULL THEN NULL WHEN price < 10 THEN '$0-$10' WHEN price < 50 THEN '$10-$50'
  WHEN price < 100 THEN '$50-$100' WHEN price < 500 THEN '$100-$500' ELSE '$500+' END"""
EMAIL = "concat(c_name, '@', lower(c_mktsegment), '.example')"


def _by(table: str, column: str) -> str:
    return f"SELECT {column}, count(*) AS event_count FROM {table} GROUP BY {column}"


def _coverage(view: str, table: str, column: str) -> str:
    return f"""
      SELECT '{view}' AS view_name, user_name, CASE WHEN bool_or(is_admin)
        THEN (SELECT count(*) FROM {table}) ELSE (SELECT count(*) FROM {table} t WHERE t.{column} IN (
          SELECT g.{column} FROM access g WHERE g.user_name = a.user_name)) END AS visible_rows
      FROM access a GROUP BY user_name"""


def _product_groups(column: str, where: str, n: int, more: str = "") -> str:
    return f"""
      SELECT {column}, count(*) AS product_count, {rnd(total('total_revenue'))} AS total_revenue,
        {rnd(mean('overall_conversion_rate'))} AS avg_conversion_rate{more}
      FROM products p WHERE {where} GROUP BY {column}
      ORDER BY {rnd(total('p.total_revenue'))} DESC, {column} LIMIT {n}"""


KEY = "event_time, user_id, product_id, user_session, event_type"


def _audience(period: str) -> str:
    bought = "CASE WHEN event_type = 'purchase' THEN {} END"
    return f"""SELECT CAST(date_trunc('{period}', event_date) AS DATE) AS period,
      count(DISTINCT user_id) AS users, count(DISTINCT {bought.format('user_id')}) AS buyers,
      count(DISTINCT product_id) AS products, count(DISTINCT {bought.format('product_id')}) AS products_sold
      FROM csv_silver GROUP BY 1"""


def _secured_views() -> str:
    parts = []
    for user, admin in ((SEGMENT_USER, False), ("analyst2@company.com", False), ("admin@company.com", True), ("x' OR true", False)):
        name = "'" + user.replace("'", "''") + "'"
        sees = "EXISTS (SELECT 1 FROM access a WHERE a.user_name = {} AND (a.is_admin OR a.{} = t.{}))"
        parts += [
            f"SELECT {name} AS user_name, 'segment' AS part, customer_segment AS value, count(*) AS n FROM customers t "
            f"WHERE {sees.format(name, 'customer_segment', 'customer_segment')} GROUP BY 3",
            f"SELECT {name}, 'category', category_l1, count(*) FROM products t "
            f"WHERE {sees.format(name, 'category_l1', 'category_l1')} GROUP BY 3",
            f"SELECT {name}, 'users', 'shown', {'count(*)' if admin else 'count(NULL)'} FROM customers",
            f"SELECT {name}, 'rows', 'no_pii', count(*) FROM customers",
            f"SELECT {name}, 'price', {chr(39) + 'clear' + chr(39) if admin else BAND}, count(*) FROM silver GROUP BY 3",
        ]
    return " UNION ALL ".join(parts)


CUSTOMER_CORE = """SELECT user_id, total_sessions, total_events, total_views, total_cart_adds,
  total_purchases, unique_products_viewed, total_revenue, avg_purchase_value, first_activity_date,
  last_activity_date, unique_days_active, view_to_cart_rate, overall_conversion_rate,
  customer_lifetime_value, days_since_last_activity,
  CASE customer_segment WHEN 'Engaged Browser' THEN 'Visitor' ELSE customer_segment END
    AS customer_segment FROM customers"""
PRODUCT_CORE = """SELECT product_id, category_id, category_code, category_l1, brand, avg_price,
  total_events, total_views, total_cart_adds, total_purchases, unique_users_total AS unique_users,
  total_revenue, view_to_cart_rate, cart_to_purchase_rate, overall_conversion_rate
  FROM product_derived"""
DAILY_CORE = """SELECT event_date, total_events, total_views, total_cart_adds, total_purchases,
  unique_users, unique_sessions, unique_buyers, total_revenue, avg_order_value,
  overall_conversion_rate, buyer_rate FROM days"""
FUNNEL_CORE = """SELECT event_date, category_l1, total_sessions, sessions_with_view,
  sessions_with_cart, sessions_with_purchase, total_revenue, session_view_to_cart_rate,
  session_cart_to_purchase_rate, cart_abandonment_rate FROM funnel"""
UPSERTED = f"""SELECT {SILVER} FROM old_rows WHERE event_id NOT IN (SELECT event_id FROM batch)
  UNION ALL SELECT {SILVER} FROM batch"""

STATEMENTS = {
    "bronze_parse": f"""SELECT date_trunc('second', event_time) AS event_time,
      trim(event_type) AS event_type, product_id, category_id, trim(category_code) AS category_code,
      trim(brand) AS brand, price, user_id, trim(user_session) AS user_session FROM bronze""",
    "csv_roundtrip": f"SELECT {RAW} FROM csv_bronze",
    "silver_clean": f"SELECT {SILVER} FROM repeated",
    "silver_dedup": f"SELECT {SILVER}, source_file, ingestion_timestamp FROM silver",
    "event_id": "SELECT event_id, event_time, user_id, product_id FROM silver",
    "category_levels": """SELECT category_code, category_l1, category_l2, category_l3, count(*) AS n
      FROM silver GROUP BY ALL""",
    "date_parts": f"""SELECT {DERIVED.split(', category')[0]}, count(*) AS n
      FROM ({derived('bronze')}) GROUP BY ALL""",
    "filter_valid": f"SELECT {RAW} FROM bronze WHERE {VALID}",
    "orders_filter_valid": f"SELECT {RAW} FROM orders_bronze WHERE {VALID}",
    "quarantine": f"SELECT {RAW}, {REASON} AS quarantine_reason FROM bronze WHERE {REJECTED}",
    "quarantine_reasons": f"""SELECT {REASON} AS quarantine_reason, count(*) AS n FROM all_bronze
      WHERE {REJECTED} GROUP BY 1""",
    "expectation_counts": " UNION ALL ".join(
        f"""SELECT '{n}' AS expectation, count(*) FILTER ({p}) AS passed,
        count(*) - count(*) FILTER ({p}) AS failed FROM bronze"""
        for n, p in RULES.items()
    ),
    "expectations_apply": f"SELECT {RAW} FROM standard WHERE "
    + " AND ".join(f"({p})" for p in RULES.values()),
    "expectations_warn": "SELECT concat_ws(',', "
    + ", ".join(f"CASE WHEN NOT coalesce({p}, false) THEN '{n}' END" for n, p in RULES.items())
    + ") AS failed, count(*) AS n FROM bronze GROUP BY 1",
    "quality_report": "SELECT count(*) AS total_records, "
    + ", ".join(f"count(*) - count({c}) AS null_{c}" for c in BRONZE_COLUMNS)
    + f""", count(*) FILTER (event_type NOT IN {TYPES}) AS invalid_event_types,
      count(*) FILTER (NOT coalesce(price BETWEEN 0 AND 100000, false)) AS out_of_range_prices,
      count(*) FILTER ({VALID}) AS valid_records,
      {pct(f'count(*) FILTER ({VALID})', 'count(*)')} AS quality_score FROM bronze""",
    "completeness_flags": f"""SELECT {_flags(('category_code', 'brand', *REQUIRED))} AS issues,
      {_flags(('category_code', 'brand', *REQUIRED))} = '' AS is_complete, count(*) AS n
      FROM bronze GROUP BY 1, 2""",
    "validity_flags": f"""SELECT coalesce(event_type IN {TYPES}, false) AS is_valid_event_type,
      coalesce(price BETWEEN 0 AND 100000, false) AS is_valid_price,
      coalesce(product_id > 0, false) AS is_valid_product_id,
      coalesce(user_id > 0, false) AS is_valid_user_id,
      category_id IS NULL OR category_id > 0 AS is_valid_category_id, count(*) AS n
      FROM all_bronze GROUP BY ALL""",
    "duplicate_count": """SELECT total_records, distinct_records,
      total_records - distinct_records AS duplicate_records FROM (
        SELECT (SELECT count(*) FROM standard) AS total_records, (SELECT count(*) FROM (
          SELECT DISTINCT event_time, user_id, product_id, user_session, event_type FROM standard))
          AS distinct_records)""",
    "duplicate_rows": f"""SELECT {RAW}, ingestion_timestamp, source_file FROM standard
      QUALIFY row_number() OVER (PARTITION BY event_time, user_id, product_id, user_session, event_type
        ORDER BY ingestion_timestamp, source_file, category_id NULLS FIRST, category_code, brand,
          price) > 1""",
    "insert_new": f"""SELECT {SILVER} FROM batch b WHERE NOT EXISTS (SELECT 1 FROM old_rows o
      WHERE o.event_time = b.event_time AND o.user_id = b.user_id AND o.product_id = b.product_id
        AND o.user_session = b.user_session AND o.event_type = b.event_type)""",
    "upsert_rows": UPSERTED,
    "upsert_table": UPSERTED,
    "customer_agg": "SELECT * FROM customer_agg",
    "customer_metrics": "SELECT * FROM customers",
    "customer_core": CUSTOMER_CORE,
    "customer_latest_day": f"""SELECT user_id, days_since_last_activity, recency_score, churn_risk
      FROM ({customer_derived('customer_dated', 'today')})""",
    "product_agg": "SELECT * FROM product_agg",
    "product_derived": "SELECT * FROM product_derived",
    "product_performance": "SELECT * FROM products",
    "product_rank_scalable": """SELECT product_id, revenue_rank_global, revenue_percentile,
      revenue_rank_in_category, revenue_rank_in_brand, performance_tier FROM products""",
    "product_core": PRODUCT_CORE,
    "daily_agg": "SELECT * FROM daily_agg",
    "daily_sales_summary": "SELECT * FROM days",
    "daily_calendar_frames": f"""SELECT event_date, revenue_7d_avg, users_7d_avg, revenue_30d_total
      FROM ({daily_derived(f"({daily_agg('orders_silver')})", *CALENDAR)})""",
    "daily_core": DAILY_CORE,
    "funnel_agg": "SELECT * FROM funnel_agg",
    "funnel_expand": "SELECT * FROM funnel_agg",
    "conversion_funnel": "SELECT * FROM funnel",
    "funnel_core": FUNNEL_CORE,
    "data_quality_metrics": f"""SELECT raw_record_count, clean_record_count,
      raw_record_count - clean_record_count AS filtered_record_count,
      {pct('clean_record_count', 'raw_record_count')} AS quality_pass_rate FROM (
        SELECT (SELECT count(*) FROM bronze) AS raw_record_count,
          (SELECT count(*) FROM silver) AS clean_record_count)""",
    "orders_customers": customer_agg("orders_silver").strip(),
    "orders_products": product_ranked(
        f"({product_derived('(' + product_agg('orders_silver') + ')')})"
    ).strip(),
    "orders_daily": daily_derived(f"({daily_agg('orders_silver')})", *ROWS).strip(),
    "orders_funnel": funnel_derived(f"({funnel_agg('orders_silver')})").strip(),
    "products_dim": "SELECT * FROM products_dim",
    "users_dim": """SELECT user_id, min(event_date) AS first_seen_date, max(event_date) AS last_seen_date,
      count(*) AS total_events FROM silver GROUP BY user_id""",
    "enrich": """SELECT s.event_id, s.product_id, s.event_type, s.price, d.brand AS dim_brand,
      d.category_l1 AS dim_category_l1, d.price AS dim_price
      FROM silver s LEFT JOIN products_dim d USING (product_id)""",
    "events_between": f"""SELECT {SILVER} FROM silver
      WHERE event_date BETWEEN DATE '{DAY_RANGE[0]}' AND DATE '{DAY_RANGE[1]}'""",
    "user_journey": f"SELECT {SILVER} FROM silver WHERE user_id = {JOURNEY_USER}",
    "purchases_in_category": f"""SELECT {SILVER} FROM silver
      WHERE event_type = 'purchase' AND category_l1 = '{CATEGORY}'""",
    "mask_functions": f"""SELECT event_id, concat('****', right(CAST(user_id AS VARCHAR), 4)) AS user_id,
      concat(left(user_session, 8), '****') AS user_session, {BAND} AS price_band,
      CASE WHEN c_custkey IS NOT NULL THEN concat(left({EMAIL}, 2), '****',
        substr({EMAIL}, instr({EMAIL}, '@'))) END AS email,
      CASE WHEN c_custkey IS NOT NULL THEN '****' END AS not_an_email
      FROM silver LEFT JOIN customer ON user_id = c_custkey""",
    "secure_by_segment": f"""SELECT * FROM customers c WHERE EXISTS (SELECT 1 FROM access a
      WHERE a.user_name = '{SEGMENT_USER}'
        AND (a.is_admin OR a.customer_segment = c.customer_segment))""",
    "secure_by_category": f"""SELECT * FROM products p WHERE EXISTS (SELECT 1 FROM access a
      WHERE a.user_name = '{SEGMENT_USER}' AND (a.is_admin OR a.category_l1 = p.category_l1))""",
    "secure_as_admin": """SELECT product_id, category_l1 FROM products p WHERE EXISTS (
      SELECT 1 FROM access a WHERE a.user_name = 'admin@company.com'
        AND (a.is_admin OR a.category_l1 = p.category_l1))""",
    "no_pii": f"SELECT {CUSTOMER_PUBLIC} FROM customers",
    "mask_customer": f"SELECT CAST(NULL AS BIGINT) AS user_id, {CUSTOMER_PUBLIC} FROM customers",
    "mask_events": f"""SELECT event_id, event_time, event_type, product_id, category_id, category_code,
      brand, {BAND} AS price, concat('****', right(CAST(user_id AS VARCHAR), 4)) AS user_id,
      concat(left(user_session, 8), '****') AS user_session, event_date, event_hour, category_l1,
      category_l2 FROM silver""",
    "mask_tagged": """SELECT event_id, concat('****', right(CAST(user_id AS VARCHAR), 4)) AS user_id,
      sha256(user_session) AS user_session, price FROM silver""",
    "access_coverage": _coverage("customer_metrics", "customers", "customer_segment")
    + " UNION ALL "
    + _coverage("product_performance", "products", "category_l1"),
    "audit_daily": """SELECT CAST(ts AS DATE) AS access_date, count(*) AS total_queries,
      count(DISTINCT user_id) AS unique_users FROM events WHERE event_type LIKE 'p%' GROUP BY 1""",
    "stream_bronze": f"SELECT {RAW} FROM csv_bronze",
    "stream_silver": f"SELECT {SILVER} FROM csv_silver",
    "stream_late": f"SELECT {SILVER} FROM csv_silver",
    "compact_partitioned": f"SELECT {SILVER} FROM silver",
    "upsert_null_partition": """SELECT CASE WHEN user_id % 3 <> 0 THEN event_type END AS kind, count(*) AS n
      FROM silver WHERE user_id % 2 = 0 OR user_id % 5 <> 4 GROUP BY 1""",
    "stream_quarantine": f"""SELECT {RAW}, {REASON} AS quarantine_reason FROM csv_bronze
      WHERE {REJECTED}""",
    "stream_upsert": f"SELECT {SILVER} FROM csv_silver",
    "batch_load": funnel_derived(f"({funnel_agg('csv_silver')})").strip(),
    "processed_files": " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS batch_id, true AS committed, CAST(1 AS BIGINT) AS files, count(*) AS input_rows "
        f"FROM csv_bronze WHERE {rows}"
        for i, rows in enumerate(DELIVERIES)
    ),
    "stream_progress": " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS batch_id, count(*) AS input_rows FROM csv_bronze WHERE {rows}"
        for i, rows in enumerate(DELIVERIES)
    ),
    "stream_late_rows": f"SELECT {SILVER}, day(event_time) <= 10 AS is_late FROM csv_silver",
    "stream_new_column": f"""SELECT {RAW}, CASE WHEN day(event_time) > 15 THEN concat('c', user_id % 10) END AS coupon
      FROM csv_bronze WHERE event_time IS NOT NULL""",
    "batch_load_twice": customer_derived(f"({customer_agg('csv_silver')})", f"DATE '{AS_OF}'").strip(),
    "batch_load_products": product_ranked(f"({product_derived('(' + product_agg('csv_silver') + ')')})").strip(),
    "batch_load_days": daily_derived(f"({daily_agg('csv_silver')})", *ROWS).strip(),
    "batch_load_funnel": funnel_derived(f"({funnel_agg('csv_silver')})").strip(),
    "batch_load_quarantine": f"""SELECT {RAW}, {REASON} AS quarantine_reason FROM csv_bronze WHERE {REJECTED}
      QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY category_id, category_code, brand, price) = 1""",
    "batch_load_quality": f"""SELECT raw_record_count, clean_record_count,
      raw_record_count - clean_record_count AS filtered_record_count,
      {pct('clean_record_count', 'raw_record_count')} AS quality_pass_rate FROM (
        SELECT (SELECT count(*) FROM (SELECT DISTINCT {KEY} FROM csv_bronze)) AS raw_record_count,
          (SELECT count(*) FROM csv_silver) AS clean_record_count)""",
    "weekly_audience": _audience("week"),
    "monthly_audience": _audience("month"),
    "sketched_audience": """SELECT DISTINCT CAST(date_trunc('week', event_date) AS DATE) AS period, true AS users_near,
      true AS buyers_near, true AS products_near, true AS products_sold_near FROM csv_silver""",
    "catalog_tables": """SELECT * FROM (
      SELECT 'events_raw' AS table_name, 'events as delivered, with lineage' AS comment, 'bronze' AS layer,
        (SELECT count(*) FROM (SELECT DISTINCT event_time, user_id, product_id, user_session, event_type FROM csv_bronze))
          AS counted_rows, 'price in shop currency' AS price_comment
      UNION ALL SELECT 'events_cleaned', 'valid unique events', 'silver', (SELECT count(*) FROM csv_silver), 'price in shop currency'
      UNION ALL SELECT 'events_quarantine', 'rejected events', 'bronze', NULL, 'price in shop currency'
      UNION ALL SELECT 'customer_metrics', 'one row per user', 'gold', (SELECT count(DISTINCT user_id) FROM csv_silver), NULL
      UNION ALL SELECT 'product_performance', 'one row per product', 'gold', (SELECT count(DISTINCT product_id) FROM csv_silver), NULL
      UNION ALL SELECT 'daily_sales_summary', 'one row per day', 'gold', NULL, NULL
      UNION ALL SELECT 'conversion_funnel', 'one row per day and top category', 'gold', NULL, NULL
      UNION ALL SELECT 'data_quality_metrics', 'how many events survive cleaning', 'gold', NULL, NULL)""",
    "load_lineage": """SELECT substr('abc', CAST(user_id % 3 AS INTEGER) + 1, 1) AS origin, count(*) AS n,
      true AS loaded_now, true AS processed_now FROM csv_silver GROUP BY 1""",
    "csv_only": "SELECT event_type, count(*) AS n FROM csv_bronze WHERE user_id % 2 = 0 GROUP BY 1",
    "malformed_records": f"""SELECT CASE WHEN user_id % 7 = 0 THEN 'malformed' ELSE {REASON} END AS quarantine_reason,
      count(*) AS n, count(*) FILTER (user_id % 7 = 0) AS with_line FROM csv_bronze
      WHERE user_id % 7 = 0 OR {REJECTED} GROUP BY 1""",
    "session_format": r"""SELECT coalesce(user_id % 2 = 0 AND regexp_matches(md5(user_session), '^[a-f0-9\-]{30,40}$'), false)
      AS valid, count(*) AS n FROM silver GROUP BY 1""",
    "column_check": """SELECT * FROM (VALUES ('silver', true, '', 13), ('raw', true, '', 0),
      ('events', false, 'brand,category_code,category_id,event_time,price,product_id,user_session', 4))
      t(table_name, complete, missing, extra)""",
    "external_table": """SELECT event_date, count(*) AS n, (SELECT count(*) FROM silver) AS counted,
      (SELECT max(product_id) FROM silver) AS greatest_product
      FROM silver WHERE event_date >= DATE '2024-01-10' GROUP BY 1""",
    "enrich_bucketed": """SELECT s.event_id, s.product_id, s.event_type, s.price, d.brand AS dim_brand,
      d.category_l1 AS dim_category_l1, d.price AS dim_price
      FROM silver s LEFT JOIN products_dim d USING (product_id)""",
    "critical_rules": " UNION ALL ".join(
        f"SELECT 'critical_{c}' AS expectation, count(*) FILTER ({c} IS NOT NULL AND user_id % {n} <> {k}) AS passed, "
        f"count(*) - count(*) FILTER ({c} IS NOT NULL AND user_id % {n} <> {k}) AS failed FROM bronze"
        for c, n, k in (("event_time", 10, 3), ("product_id", 7, 2), ("user_id", 11, 5))
    ),
    "audited_load": " UNION ALL ".join(
        f"SELECT '{n}' AS expectation, 'drop' AS action, count(*) FILTER ({p}) AS passed, "
        f"count(*) - count(*) FILTER ({p}) AS failed FROM bronze"
        for n, p in RULES.items()
    ),
    "audited_rows": f"SELECT {RAW} FROM standard WHERE " + " AND ".join(f"({p})" for p in RULES.values()),
    "expectation_fail": f"SELECT {RAW}, 2 AS broken_rules FROM bronze WHERE {VALID}",
    "secured_views": _secured_views(),
    "orders_customer_metrics": customer_derived(f"""({customer_agg("""(SELECT * FROM orders_silver
        WHERE (event_type <> 'purchase' OR user_id % 6 IN (0, 1) OR (user_id % 6 = 2 AND product_id % 3 = 0))
        AND (user_id % 9 <> 4 OR event_type = 'view')
        AND (user_id % 9 <> 5 OR (event_type = 'view' AND product_id % 20 = 0)))""")})""", f"DATE '{ORDERS_AS_OF}'").strip(),
    "mask_events_engineer": """SELECT event_id, event_time, event_type, product_id, category_id, category_code,
      brand, CAST(price AS VARCHAR) AS price, CAST(user_id AS VARCHAR) AS user_id, user_session, event_date, event_hour,
      category_l1, category_l2 FROM silver""",
    "mask_customer_engineer": f"SELECT user_id, {CUSTOMER_PUBLIC} FROM customers",
    "profile_csv": "SELECT count(*) AS row_count, "
    + ", ".join(f"count(*) - count({c}) AS null_{c}" for c in RAW.split(", "))
    + " FROM csv_bronze",
    "null_profile": "SELECT "
    + ", ".join(f"count(*) - count({c}) AS {c}" for c in BRONZE_COLUMNS)
    + " FROM bronze",
    "compact": f"SELECT {SILVER} FROM silver",
    "cluster": f"SELECT {SILVER} FROM silver",
    "retention": f"SELECT {SILVER} FROM silver WHERE event_date >= DATE '{AS_OF}' - 14",
    "bronze_type_distribution": _by("bronze", "event_type"),
    "event_type_distribution": _by("silver", "event_type"),
    "date_range": """SELECT min(event_time) AS min_date, max(event_time) AS max_date,
      CAST(date_diff('day', CAST(min(event_time) AS DATE), CAST(max(event_time) AS DATE)) AS INTEGER)
        AS days_span FROM bronze""",
    "top_categories": _by("silver", "category_l1") + " ORDER BY 2 DESC, 1 LIMIT 10",
    "top_brands": """SELECT brand, count(*) AS event_count FROM silver WHERE brand <> 'unknown'
      GROUP BY brand ORDER BY 2 DESC, 1 LIMIT 10""",
    "default_fill_counts": """SELECT count(*) AS total, count(*) FILTER (brand = 'unknown')
      AS unknown_brands, count(*) FILTER (category_code = 'unknown') AS unknown_categories
      FROM silver""",
    "hourly_pattern": f"""SELECT event_hour, count(*) AS total_events,
      count(*) {only('purchase')} AS total_purchases,
      {total("CASE WHEN event_type = 'purchase' THEN price END")} AS total_revenue
      FROM silver GROUP BY event_hour""",
    "top_customers": """SELECT user_id, customer_lifetime_value, total_purchases, customer_segment,
      rfm_score, churn_risk FROM customers ORDER BY customer_lifetime_value DESC, user_id LIMIT 10""",
    "segment_distribution": f"""SELECT customer_segment, count(*) AS customer_count,
      {rnd(mean('total_revenue'))} AS avg_revenue, {rnd('avg(total_purchases)')} AS avg_purchases
      FROM customers GROUP BY customer_segment""",
    "customer_summary": f"""SELECT count(*) AS total_customers,
      {total('total_revenue')} AS total_revenue, {mean('total_revenue')} AS avg_clv,
      CAST(sum(total_purchases) AS DOUBLE) / count(*) AS avg_purchases,
      count(*) FILTER (churn_risk = 'High') AS high_churn_risk FROM customers""",
    "top_products": """SELECT product_id, brand, category_l1, total_revenue, total_purchases,
      overall_conversion_rate, performance_tier FROM products
      ORDER BY total_revenue DESC, product_id LIMIT 10""",
    "revenue_by_category": _product_groups(
        "category_l1", "true", 15, ", CAST(sum(total_views) AS BIGINT) AS total_views"
    ),
    "revenue_by_brand": _product_groups("brand", "brand <> 'unknown'", 10),
    "product_summary": f"""SELECT count(*) AS total_products, {total('total_revenue')} AS total_revenue,
      {rnd(mean('overall_conversion_rate'))} AS avg_conversion_rate,
      CAST(sum(total_purchases) AS BIGINT) AS total_purchases FROM products""",
    "revenue_trend": """SELECT event_date, day_name, total_revenue, revenue_dod_change, revenue_7d_avg,
      unique_users, total_purchases FROM days ORDER BY event_date DESC LIMIT 30""",
    "day_of_week": f"""SELECT day_name, day_of_week, count(*) AS num_days,
      {rnd(mean('total_revenue'))} AS avg_revenue, {rnd('avg(unique_users)')} AS avg_users,
      {rnd(mean('overall_conversion_rate'))} AS avg_conversion_rate FROM days GROUP BY 1, 2""",
    "daily_summary": f"""SELECT count(*) AS total_days, {total('total_revenue')} AS total_revenue,
      {rnd(mean('total_revenue'))} AS avg_daily_revenue, {rnd('avg(unique_users)')} AS avg_daily_users,
      {rnd(mean('overall_conversion_rate'))} AS avg_conversion_rate FROM days""",
    "latest_funnel": """SELECT event_date, category_l1, sessions_with_view, sessions_with_cart,
      sessions_with_purchase, session_view_to_cart_rate, session_cart_to_purchase_rate,
      cart_abandonment_rate FROM funnel
      ORDER BY event_date DESC, total_sessions DESC, category_l1 LIMIT 20""",
    "overall_funnel": f"""SELECT CAST(v AS BIGINT) AS total_view_sessions,
      CAST(c AS BIGINT) AS total_cart_sessions, CAST(p AS BIGINT) AS total_purchase_sessions,
      total_revenue, {pct('c', 'v')} AS overall_view_to_cart_rate,
      {pct('p', 'c')} AS overall_cart_to_purchase_rate, {pct('p', 'v')} AS overall_conversion_rate
      FROM (SELECT sum(sessions_with_view) AS v, sum(sessions_with_cart) AS c,
        sum(sessions_with_purchase) AS p, {total('total_revenue')} AS total_revenue FROM funnel)""",
    "funnel_by_category": f"""SELECT category_l1,
      CAST(sum(sessions_with_view) AS BIGINT) AS view_sessions,
      CAST(sum(sessions_with_cart) AS BIGINT) AS cart_sessions,
      CAST(sum(sessions_with_purchase) AS BIGINT) AS purchase_sessions,
      {rnd(mean('session_view_to_cart_rate'))} AS avg_view_to_cart,
      {rnd(mean('session_cart_to_purchase_rate'))} AS avg_cart_to_purchase,
      {rnd(mean('cart_abandonment_rate'))} AS avg_cart_abandonment,
      {total('f.total_revenue')} AS total_revenue
      FROM funnel f GROUP BY category_l1
      ORDER BY {total('f.total_revenue')} DESC, category_l1 LIMIT 15""",
    "cart_abandonment": f"""SELECT category_l1,
      CAST(sum(sessions_with_cart) AS BIGINT) AS total_cart_sessions,
      CAST(sum(cart_dropoff) AS BIGINT) AS total_cart_abandonments,
      {rnd(mean('cart_abandonment_rate'))} AS avg_abandonment_rate
      FROM funnel GROUP BY category_l1 HAVING sum(sessions_with_cart) > 100
      ORDER BY 4 DESC, 1 LIMIT 10""",
    "funnel_summary": f"""SELECT CAST(v AS BIGINT) AS total_view_sessions,
      CAST(p AS BIGINT) AS total_purchase_sessions, avg_cart_abandonment, total_revenue,
      {pct('p', 'v')} AS overall_conversion
      FROM (SELECT sum(sessions_with_view) AS v, sum(sessions_with_purchase) AS p,
        {rnd(mean('cart_abandonment_rate'))} AS avg_cart_abandonment,
        {total('total_revenue')} AS total_revenue FROM funnel)""",
}

ORACLE = {name: query(sql) for name, sql in STATEMENTS.items()}
