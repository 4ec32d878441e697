from __future__ import annotations

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopstream.functions.numerics import first_match, money_ratio, pct, ratio, rounded, safe_ratio, units
from shopstream.plans import customer, daily, funnel, product, reports
from shopstream.plans.quality_metrics import quality_metrics
from shopstream.schema import EVENT_TYPES
from tests.conftest import LOADED, by_key, make_silver, rows_of

AS_OF = "2021-03-15"


# customers

def test_customer_counts_and_value(silver):
    rows = by_key(customer.customer_metrics(silver, AS_OF), "user_id")
    assert len(rows) == 3
    got = {u: (r["total_events"], r["total_views"], r["total_purchases"], r["total_revenue"]) for u, r in rows.items()}
    assert got == {901: (6, 3, 2, 27.7), 902: (3, 1, 0, 0.0), 903: (3, 3, 0, 0.0)}
    assert rows[901]["customer_lifetime_value"] == 27.7
    assert rows[901]["avg_purchase_value"] == pytest.approx(13.85)
    assert rows[902]["avg_purchase_value"] is None and rows[902]["max_purchase_value"] is None


def test_customer_segments_scores_and_risk(silver):
    rows = by_key(customer.customer_metrics(silver, AS_OF), "user_id")
    assert {u: r["customer_segment"] for u, r in rows.items()} == {
        901: "Potential Loyalist",
        902: "Cart Abandoner",
        903: "Visitor",
    }
    first = rows[901]
    assert (first["recency_score"], first["frequency_score"], first["monetary_score"], first["rfm_score"]) == (5, 2, 2, 9)
    assert (first["churn_risk"], rows[902]["churn_risk"]) == ("Low", "N/A")


def test_customer_details(silver):
    row = by_key(customer.customer_metrics(silver, AS_OF), "user_id")[901]
    assert row["first_activity_time"] == datetime(2021, 3, 11, 8)
    assert (row["first_purchase_date"], row["last_purchase_date"]) == (date(2021, 3, 11), date(2021, 3, 12))
    assert (row["days_since_last_activity"], row["days_since_last_purchase"], row["customer_tenure_days"]) == (3, 3, 1)
    assert (row["most_active_hour"], row["top_category"], row["top_brand"]) == (8, "garden", "birchwood")
    assert (row["unique_products_viewed"], row["unique_products_carted"], row["unique_products_purchased"]) == (2, 1, 2)
    assert (row["avg_events_per_session"], row["avg_events_per_day"]) == (3.0, 3.0)


def test_viewed_products_count_every_event_type(spark):
    df = make_silver(spark, [("2019-10-01 10:00:00", "cart", 1, "a.b", "x", 1.0, 7, "s")])
    assert customer.aggregate(df).first()["unique_products_viewed"] == 1


def test_mode_ties_go_to_the_lowest(spark):
    rows = [
        (f"2019-10-01 {h}:0{i}:00", "view", 1, c, b, 1.0, 7, "s")
        for i, (h, c, b) in enumerate([("12", "z.z", "q"), ("09", "a.a", "p"), ("12", "a.a", "q"), ("09", "z.z", "p")])
    ]
    row = customer.aggregate(make_silver(spark, rows)).first()
    assert (row["most_active_hour"], row["top_category"], row["top_brand"]) == (9, "a", "p")


def test_unknown_is_no_favourite_brand(spark):
    df = make_silver(spark, [("2019-10-01 10:00:00", "view", 1, "unknown", "unknown", 1.0, 7, "s")])
    row = customer.aggregate(df).first()
    assert row["top_brand"] is None and row["top_category"] == "unknown"


def test_recency_runs_from_the_last_day_by_default(silver):
    rows = by_key(customer.customer_metrics(silver), "user_id")
    assert (rows[901]["days_since_last_activity"], rows[902]["days_since_last_activity"]) == (0, 1)
    given = customer.customer_metrics(silver, F.lit("2021-06-30").cast("date"))
    assert by_key(given, "user_id")[901]["churn_risk"] == "High"


def test_churn_bounds(silver):
    risk = {}
    for day in ("2021-03-26", "2021-03-27", "2021-04-11", "2021-04-12"):
        risk[day] = by_key(customer.customer_metrics(silver, day), "user_id")[901]["churn_risk"]
    assert list(risk.values()) == ["Low", "Medium", "Medium", "High"]


def test_engaged_browser_is_a_visitor_in_the_core_variant(spark):
    rows = [(f"2019-10-01 10:{i:02d}:00", "view", 1, "a.b", "x", 1.0, 7, "s") for i in range(11)]
    df = make_silver(spark, rows)
    assert customer.customer_metrics(df).first()["customer_segment"] == "Engaged Browser"
    core = customer.customer_metrics(df, columns="core")
    assert core.columns == list(customer.CORE) and core.first()["customer_segment"] == "Visitor"


def test_missing_session_counts_as_no_session(spark):
    df = make_silver(spark, [("2019-10-01 10:00:00", "view", 1, "a.b", "x", 1.0, 7, None)])
    row = customer.customer_metrics(df).first()
    assert (row["total_sessions"], row["total_events"], row["avg_events_per_session"]) == (0, 1, None)
    assert funnel.conversion_funnel(df).first()["total_sessions"] == 0
    assert daily.daily_sales_summary(df).first()["events_per_session"] is None


# products

def test_product_counts_rates_and_revenue(silver):
    rows = by_key(product.product_performance(silver), "product_id")
    assert sorted(rows) == [31, 47, 52, 80]
    assert (rows[31]["total_views"], rows[31]["total_purchases"]) == (3, 1)
    assert [rows[p]["overall_conversion_rate"] for p in (31, 47, 52)] == [33.33, 100.0, 0.0]
    assert [rows[p]["total_revenue"] for p in (31, 47, 80)] == [24.5, 3.2, 0.0]
    assert rows[31]["revenue_per_view"] == 8.1667 and rows[31]["unique_users_total"] == 2


def test_best_product_has_the_top_tier(silver):
    rows = by_key(product.product_performance(silver), "product_id")
    assert {p: (r["revenue_rank_global"], r["revenue_percentile"], r["performance_tier"]) for p, r in rows.items()} == {
        31: (1, 100.0, "Top 10%"),
        47: (2, 66.67, "Top 50%"),
        52: (3, 0.0, "Bottom 25%"),
        80: (3, 0.0, "Bottom 25%"),
    }
    assert (rows[47]["revenue_rank_in_category"], rows[47]["revenue_rank_in_brand"]) == (2, 1)
    assert [rows[p]["popularity_score"] for p in (31, 47, 52, 80)] == [1.1, 1.0, 0.7, 0.2]


def test_attributes_come_from_the_first_event_and_price_from_the_last(spark):
    rows = [
        ("2019-10-02 10:00:00", "view", 1, "b.b", "late", 5.0, 7, "s"),
        ("2019-10-01 10:00:00", "view", 1, "a.a", "early", 9.0, 7, "s"),
        ("2019-10-03 10:00:00", "view", 1, "a.a", "early", 7.0, 7, "s"),
    ]
    row = product.aggregate(make_silver(spark, rows)).first()
    assert (row["category_l1"], row["brand"], row["current_price"]) == ("a", "early", 7.0)
    assert (row["avg_price"], row["min_price"], row["max_price"]) == (7.0, 5.0, 9.0)


def test_ranks_equal_plain_windows(shop):
    got = product.product_performance(shop)
    down = F.desc("total_revenue")
    wanted = got.withColumns(
        {
            "revenue_rank_global": F.dense_rank().over(Window.orderBy(down)),
            "revenue_percentile": F.round(F.percent_rank().over(Window.orderBy("total_revenue")) * 100, 2),
            "revenue_rank_in_category": F.dense_rank().over(Window.partitionBy("category_l1").orderBy(down)),
            "revenue_rank_in_brand": F.dense_rank().over(Window.partitionBy("brand").orderBy(down)),
        }
    )
    assert rows_of(got) == rows_of(wanted)


def test_product_ranking_is_bounded(shop):
    plan = product.product_performance(shop)._jdf.queryExecution().optimizedPlan().toString()
    # The only windows over a whole group run over totals of coarse buckets.
    for line in plan.splitlines():
        if "Window [" in line:
            assert "_coarse" in line or "_fine" in line or "_values" in line, line
    # Ranks read the written aggregates, not the events.
    assert "event_time" not in plan and "user_session" not in plan


def test_rates_are_rounded_once(spark):
    df = spark.createDataFrame([(148588, 1203629, 2469, 20000)], "a bigint, b bigint, c bigint, d bigint")
    row = df.select(pct("a", "b").alias("below"), ratio("c", "d * 0.01").alias("tie"), money_ratio("3.015D", "3").alias("money")).first()
    assert tuple(row) == (12.34, 12.35, 1.01)


def test_core_products(silver):
    out = product.product_performance(silver, columns="core")
    assert out.columns == list(product.CORE) and by_key(out, "product_id")[31]["unique_users"] == 2


# days

def test_days(silver):
    rows = daily.daily_sales_summary(silver).collect()
    assert [r["event_date"] for r in rows] == [date(2021, 3, 11), date(2021, 3, 12)]
    assert [r["total_revenue"] for r in rows] == [3.2, 24.5]
    assert [r["unique_users"] for r in rows] == [2, 2]
    assert [(r["day_name"], r["is_weekend"]) for r in rows] == [("Thursday", False), ("Friday", False)]
    assert [r["revenue_dod_change"] for r in rows] == [0.0, 665.63]
    assert [r["revenue_7d_avg"] for r in rows] == [3.2, 13.85]
    assert [r["buyer_rate"] for r in rows] == [50.0, 50.0]


def test_frames_over_rows_and_over_days(spark):
    rows = [(f"2019-{m}-01 10:00:00", "purchase", 1, "a.b", "x", 10.0, 7, "s") for m in ("10", "11")]
    df = make_silver(spark, rows)
    assert daily.daily_sales_summary(df).collect()[1]["revenue_30d_total"] == 20.0
    assert daily.daily_sales_summary(df, frame="days").collect()[1]["revenue_30d_total"] == 10.0


def test_approximate_days_have_the_same_shape(shop):
    exact, sketched = daily.daily_sales_summary(shop), daily.daily_sales_summary(shop, approx=0.01)
    assert exact.dtypes == sketched.dtypes
    plain = [c for c in exact.columns if "unique" not in c and "user" not in c and "session" not in c]
    plain = [c for c in plain if c not in ("buyer_rate", "categories_with_sales", "brands_with_sales")]
    assert rows_of(exact, *plain) == rows_of(sketched, *plain)


def test_core_days(silver):
    assert daily.daily_sales_summary(silver, columns="core").columns == list(daily.CORE)


# funnel

def test_funnel_stages(silver):
    rows = {(r["event_date"], r["category_l1"]): r for r in funnel.conversion_funnel(silver).collect()}
    row = rows[(date(2021, 3, 12), "garden")]
    assert (row["sessions_with_view"], row["sessions_with_cart"], row["sessions_with_purchase"]) == (2, 0, 1)
    assert (row["cart_abandonment_rate"], row["view_dropoff"], row["view_dropoff_rate"]) == (0.0, 2, 100.0)
    row = rows[(date(2021, 3, 11), "lighting")]
    assert (row["cart_abandonment_rate"], row["view_dropoff"], row["net_cart_adds"]) == (100.0, 0, 0)


def test_abandonment_over_all_days_may_be_negative(silver):
    out = funnel.derive(funnel.aggregate(silver, by=["category_l1"]))
    rates = {r["category_l1"]: r["cart_abandonment_rate"] for r in out.collect()}
    assert rates == {"garden": -100.0, "kitchen": 0.0, "lighting": 100.0}


@pytest.mark.parametrize("strategy", ["two_level", "expand"])
def test_strategies_agree(shop, strategy):
    assert rows_of(funnel.aggregate(shop, strategy=strategy)) == rows_of(funnel.aggregate(shop))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["2019-10-01 10:00:00", "2019-10-02 11:00:00"]),
            st.sampled_from(EVENT_TYPES),
            st.integers(1, 3),
            st.sampled_from(["a.x", "b.y", "unknown"]),
            st.sampled_from(["p", "unknown"]),
            st.sampled_from([0.0, 0.1, 19.99]),
            st.integers(1, 3),
            st.sampled_from([None, "", "s1", "s2"]),
        ),
        min_size=1,
        max_size=30,
    )
)
def test_grains_equal_literal_distinct_counts(spark, rows):
    df = make_silver(spark, rows)
    assert rows_of(funnel.aggregate(df)) == rows_of(funnel.aggregate(df, strategy="expand"))
    literal = df.groupBy("user_id").agg(
        F.count_distinct("user_session").alias("total_sessions"),
        F.count_distinct(F.expr("CASE WHEN event_type = 'cart' THEN product_id END")).alias(
            "unique_products_carted"
        ),
        F.count_distinct("brand").alias("unique_brands_engaged"),
        F.expr("mode(event_hour, true)").alias("most_active_hour"),
        F.expr("mode(category_l1, true)").alias("top_category"),
    )
    assert rows_of(customer.aggregate(df).select(*literal.columns)) == rows_of(literal)


def test_unknown_strategy(silver):
    with pytest.raises(ValueError):
        funnel.aggregate(silver, strategy="guess")


def test_approximate_funnel(shop):
    assert funnel.conversion_funnel(shop, approx=0.02).dtypes == funnel.conversion_funnel(shop).dtypes


def test_core_funnel_is_a_projection(shop):
    wanted = funnel.conversion_funnel(shop).select(*funnel.CORE)
    assert rows_of(funnel.conversion_funnel(shop, columns="core")) == rows_of(wanted)


def test_two_levels_copy_rows_less(silver):
    def copies(strategy):
        plan = funnel.aggregate(silver, strategy=strategy)._jdf.queryExecution().executedPlan().toString()
        line = next(x for x in plan.splitlines() if "Expand" in x)
        return line.split("], [")[0:-1]

    assert (len(copies("two_level")), len(copies("expand"))) == (3, 12)


# all tables

def test_empty_input_gives_empty_tables(spark):
    empty = make_silver(spark, [("2019-10-01 10:00:00", "view", 1, "a.b", "x", 1.0, 7, "s")]).limit(0)
    for build in (
        customer.customer_metrics,
        product.product_performance,
        daily.daily_sales_summary,
        funnel.conversion_funnel,
    ):
        assert build(empty).count() == 0


def test_audit_column_is_optional(silver):
    assert "processed_timestamp" in funnel.conversion_funnel(silver, audit=True).columns
    assert "processed_timestamp" not in funnel.conversion_funnel(silver).columns


def test_quality_metrics(dirty, silver):
    row = quality_metrics(dirty, silver.limit(7)).first()
    assert tuple(row) == (9, 7, 2, 77.78)
    none = quality_metrics(dirty.limit(0), silver.limit(0), F.lit(LOADED)).first()
    assert tuple(none) == (LOADED, 0, 0, 0, 0.0)


def test_a_hot_user_is_spread_over_tasks(spark):
    """Nearly all rows belong to one user; the first shuffle still uses every partition."""
    hot = make_silver(spark, [("2019-10-01 10:00:00", "view", 1, "a.b", "x", 1.0, 7, "s")]).drop("product_id")
    hot = hot.join(spark.range(2000).withColumnRenamed("id", "product_id"), F.lit(True))
    from shopstream.operators.grains import entity_grains, type_sums, typed

    grains = entity_grains(
        typed(hot, ["user_id", "product_id"]), ["user_id"], {"product": "product_id"}, type_sums()
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in grains.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 700


# numbers

def test_rates(spark):
    df = spark.createDataFrame([(0, 1), (1, 3), (1, 160), (-1, 160)], "d int, n int")
    assert [r[0] for r in df.select(pct("n", "d")).collect()] == [0.0, 300.0, 16000.0, 0.0]
    assert spark.range(1).select(pct("1", "160")).first()[0] == 0.63
    assert spark.range(1).select(safe_ratio("1", "0")).first()[0] is None


def test_ties_are_decided_in_decimal(spark):
    one = spark.range(1)
    assert one.select(rounded(F.lit(37.05) / 6)).first()[0] == 6.18
    assert one.select(rounded(F.lit(1.005))).first()[0] == 1.01


def test_absent_prices_are_skipped(spark):
    df = spark.createDataFrame([(1, 100.0), (2, None)], "id bigint, price double")
    assert df.agg((F.sum(units("price")) / 10000).alias("s")).first()[0] == 100.0


def test_money_sums_do_not_drift(spark):
    df = spark.range(100_000).select(F.lit(0.1).alias("p"))
    assert df.agg(F.sum(units("p")).alias("u")).first()["u"] == 100_000 * 1000


def test_first_match_without_default(spark):
    assert spark.range(1).select(first_match([(F.lit(False), 1)])).first()[0] is None


# reports

def test_silver_reports(silver):
    assert [tuple(r) for r in reports.event_type_distribution(silver).collect()][0] == ("view", 7)
    assert reports.date_range(silver).first()["days_span"] == 1
    assert [r["category_l1"] for r in reports.top_categories(silver, 1).collect()] == ["garden"]
    assert [r["brand"] for r in reports.top_brands(silver).collect()] == ["birchwood", "lumen", "sproutco", "panco"]
    assert tuple(reports.default_fill_counts(silver).first()) == (12, 0, 0)
    assert reports.events_between(silver, "2021-03-12", "2021-03-12").count() == 5
    assert [r["event_type"] for r in reports.user_journey(silver, 902).collect()] == ["view", "cart", "remove_from_cart"]
    assert reports.purchases_in_category(silver, "garden").count() == 2
    assert {r["event_hour"]: r["total_revenue"] for r in reports.hourly_pattern(silver).collect()}[20] == 24.5


def test_gold_reports(silver):
    customers = customer.customer_metrics(silver, AS_OF)
    assert reports.top_customers(customers, 1).first()["user_id"] == 901
    assert reports.segment_distribution(customers).count() == 3
    assert reports.customer_summary(customers).first()["total_revenue"] == 27.7
    products = product.product_performance(silver)
    assert [r["product_id"] for r in reports.top_products(products).collect()] == [31, 47, 52, 80]
    assert reports.revenue_by_category(products).first()["total_revenue"] == 27.7
    assert reports.revenue_by_brand(products, 1).first()["brand"] == "birchwood"
    assert reports.product_summary(products).first()["total_purchases"] == 2
    days = daily.daily_sales_summary(silver)
    assert reports.revenue_trend(days, 1).first()["event_date"] == date(2021, 3, 12)
    assert reports.day_of_week(days).count() == 2
    assert reports.daily_summary(days).first()["avg_daily_revenue"] == 13.85
    stages = funnel.conversion_funnel(silver)
    assert reports.latest_funnel(stages, 2).count() == 2
    assert reports.overall_funnel(stages).first()["overall_view_to_cart_rate"] == 33.33
    assert reports.funnel_by_category(stages).first()["category_l1"] == "garden"
    assert reports.cart_abandonment(stages).count() == 0
    assert reports.cart_abandonment(stages, min_sessions=0).first()["category_l1"] == "lighting"
    assert reports.funnel_summary(stages).first()["total_purchase_sessions"] == 2
