"""Audited writes, protected SQL views, catalog tables."""

from __future__ import annotations

import pytest

from shopstream.operators import dims, publish, quality, security, views
from shopstream.plans import product
from shopstream.plans.customer import customer_metrics
from shopstream.sources import catalog, tables
from shopstream.sources.access import access_map
from tests.conftest import rows_of


def test_counts_equal_a_second_scan(spark, dirty, tmp_path):
    audit = publish.publish(dirty, str(tmp_path / "t"), quality.EXPECTATIONS, "drop", ["event_type"])
    want = {r.expectation: (r.passed, r.failed) for r in quality.expectation_counts(dirty).collect()}
    found = {r.expectation: (r.passed, r.failed) for r in audit.report(spark).collect()}
    assert found == want and audit.rows == dirty.count()
    kept = quality.apply(dirty, quality.EXPECTATIONS)
    assert rows_of(tables.read_table(spark, str(tmp_path / "t"))) == rows_of(kept) and audit.written == kept.count()


def test_a_failing_rule_publishes_nothing(spark, dirty, tmp_path):
    path, rules = str(tmp_path / "t"), {"time": "event_time IS NOT NULL", "price": "price >= 0", "brand": "brand IS NOT NULL"}
    good = quality.filter_valid(dirty, {n: rules[n] for n in ("time", "price")})
    audit = publish.publish(good, path, rules, {"time": "fail", "price": "fail"})
    assert audit.broken == [] and audit.failed["brand"] > 0 and audit.written == audit.rows
    before = rows_of(tables.read_table(spark, path))
    for mode in ("replace", "append"):
        with pytest.raises(publish.ExpectationsFailed, match="time fails 1 rows") as refused:
            publish.publish(dirty, path, rules, {"time": "fail", "price": "drop"}, mode=mode)
        assert refused.value.audit.failed["price"] == 1 and rows_of(tables.read_table(spark, path)) == before
    assert tables.children(spark, str(tmp_path)) == ["t"]


def test_appends_keep_what_is_there(spark, silver, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        publish.publish(silver, path, {"any": "true"}, "warn", ["event_date"], "append")
    publish.publish(silver.limit(0), path, {"any": "true"}, mode="append")
    assert tables.read_table(spark, path).count() == 2 * silver.count()
    with pytest.raises(ValueError):
        publish.publish(silver, path, {"any": "true"}, "ignore")


def test_views_equal_the_functions(spark, silver):
    grants = [("ana@shop.example", "New Customer", "garden", False), ("root@shop.example", None, None, True), ("o'neil", "Visitor", "lighting", None)]
    access, customers, products = access_map(spark, grants), customer_metrics(silver, "2021-03-15", audit=True), product.product_performance(silver)
    views.act_as(spark, "nobody")
    names = views.create_views(spark, access, customers, products, silver)
    assert len(names) == 5
    for user in ("ana@shop.example", "root@shop.example", "o'neil", "x' OR 'a' = 'a"):
        for groups in ((), ("data-engineers",)):
            views.act_as(spark, user, groups)
            skip = "processed_timestamp"
            seen = {n: rows_of(spark.table(n).drop(skip)) for n in names}
            assert seen["customer_metrics_secured"] == rows_of(security.secure_by_segment(customers, access, user).drop(skip))
            assert seen["product_performance_secured"] == rows_of(security.secure_by_category(products, access, user))
            assert seen["customer_metrics_masked"] == rows_of(security.mask_customer(customers, groups).drop(skip))
            assert seen["events_cleaned_masked"] == rows_of(security.mask_events(silver, groups).drop(skip))
            assert seen["customer_metrics_no_pii"] == rows_of(security.no_pii(customers).drop(skip))


def test_a_secured_view_filters_in_the_scan(spark, silver):
    views.act_as(spark, "ana@shop.example")
    views.create_views(spark, access_map(spark), customer_metrics(silver, "2021-03-15"), product.product_performance(silver), silver)
    main = spark.table("product_performance_secured")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in main and "Cartesian" not in main


def test_bucketed_tables_join_without_a_shuffle(spark, silver):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = catalog.write_bucketed(silver, "b_events", "product_id", 4)
        right = catalog.write_bucketed(dims.products_dim(silver), "b_products", "product_id", 4)
        joined = dims.enrich(left, right, "product_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert rows_of(joined) == rows_of(dims.enrich(silver, dims.products_dim(silver), "product_id"))
        # An unbucketed side is the only one that moves.
        one = dims.enrich(left, dims.products_dim(silver), "product_id")._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in one
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_described_table(spark, silver, tmp_path):
    path = str(tmp_path / "t")
    tables.write_full(silver, path, ["event_date"])
    for _ in range(2):
        catalog.register(spark, "described", path, "it's here", {"layer": "silver"}, {"price": "what it costs"}, ["price", "absent"])
    assert catalog.details(spark, "described")["Comment"] == "it's here"
    assert catalog.properties(spark, "described")["layer"] == "silver"
    assert spark.table("described").schema["price"].metadata["comment"] == "what it costs"
    assert catalog.counted_rows(spark, "described") == silver.count()
    assert catalog.column_statistics(spark, "described", "price")["max"] == "61.75"
