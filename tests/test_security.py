from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shopstream.functions import masking as m
from shopstream.operators import dims, security
from shopstream.plans.customer import customer_metrics
from shopstream.sources.access import access_map
from tests.conftest import rows_of

CASES = [
    (m.mask_user_id, "bigint", 512563789, "****3789"),
    (m.mask_user_id, "bigint", 12, "****12"),
    (m.mask_session, "string", "abc123-def456-ghi789", "abc123-d****"),
    (m.mask_price, "double", 9.99, "$0-$10"),
    (m.mask_price, "double", 10.0, "$10-$50"),
    (m.mask_price, "double", 499.99, "$100-$500"),
    (m.mask_price, "double", 500.0, "$500+"),
    (m.mask_email, "string", "jane@x.org", "ja****@x.org"),
    (m.mask_email, "string", "nobody", "****"),
    *[(f, t, None, None) for f, t in (
        (m.mask_user_id, "bigint"), (m.mask_session, "string"), (m.mask_price, "double"), (m.mask_email, "string")
    )],
]

GRANTS = (
    ("ana@shop.example", "Champion", "garden"),
    ("ana@shop.example", "Loyal", "garden"),
    ("ben@shop.example", "Champion", "lighting"),
    ("root@shop.example", None, None, True),
)


@pytest.mark.parametrize("mask,kind,value,shown", CASES)
def test_masks(spark, mask, kind, value, shown):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    assert df.select(mask("v")).first()[0] == shown


@pytest.mark.parametrize("mask,kind,value,shown", CASES)
def test_masks_from_sql(spark, mask, kind, value, shown):
    security.register_sql_masks(spark)
    df = spark.createDataFrame([(value,)], f"v {kind}")
    assert df.selectExpr(f"{mask.__name__}(v)").first()[0] == shown


@pytest.fixture
def segments(spark):
    return spark.createDataFrame([("Champion",), ("Loyal",), ("Visitor",), (None,)], "customer_segment string")


@pytest.mark.parametrize(
    "user,seen",
    [
        ("analyst1@company.com", ["Champion", "Loyal"]),
        ("analyst2@company.com", ["Champion"]),
        ("admin@company.com", ["Champion", "Loyal", "Visitor", None]),
        ("nobody@company.com", []),
    ],
)
def test_rows_by_segment(spark, segments, user, seen):
    out = security.secure_by_segment(segments, access_map(spark), user)
    assert [r[0] for r in rows_of(out)] == sorted(seen, key=lambda v: repr((v,)))


@pytest.mark.parametrize(
    "user,seen", [("ana@shop.example", 7), ("ben@shop.example", 5), ("root@shop.example", 14), ("x", 0)]
)
def test_rows_by_category(spark, silver, user, seen):
    rows = silver.select("category_l1").union(spark.createDataFrame([("toys",)], "c string"))
    rows = rows.union(spark.createDataFrame([("lighting",)], "c string"))
    assert security.secure_by_category(rows, access_map(spark, GRANTS), user).count() == seen


def test_row_filter_does_not_shuffle_the_table(spark, silver):
    out = security.secure_by_category(silver, access_map(spark), "analyst1@company.com")
    main = out._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Join" not in main and "Exchange" not in main


def test_admin_flag_defaults_to_no(spark):
    assert access_map(spark, [("a", "Loyal", None)]).first()["is_admin"] is False


def test_customer_views(silver):
    customers = customer_metrics(silver, "2021-03-15", audit=True)
    assert security.no_pii(customers).columns == list(security.CUSTOMER_PUBLIC)
    hidden = security.mask_customer(customers, ["data-analysts"])
    assert {r["user_id"] for r in hidden.collect()} == {None}
    shown = security.mask_customer(customers, ["data-engineers"])
    assert {r["user_id"] for r in shown.collect()} == {901, 902, 903} and shown.dtypes == hidden.dtypes


def test_event_view(silver):
    hidden, shown = security.mask_events(silver), security.mask_events(silver, ["data-engineers"])
    assert hidden.dtypes == shown.dtypes
    row = hidden.orderBy("event_time").first()
    assert (row["price"], row["user_id"], row["user_session"]) == ("$10-$50", "****901", "ann-4****")
    assert shown.orderBy("event_time").first()["user_id"] == "901"


def test_tags_survive_files_and_drive_masks(spark, silver, tmp_path):
    tags = {
        "user_id": {"pii": "true", "mask_type": "partial"},
        "user_session": {"pii": "true", "mask_type": "hash"},
        "brand": {"pii": "true", "mask_type": "partial"},
        "price": {"sensitivity": "internal"},
    }
    path = str(tmp_path / "tagged")
    security.tag_columns(silver, tags).write.parquet(path)
    stored = spark.read.parquet(path)
    row = security.mask_tagged(stored).orderBy("event_time").first()
    assert row["user_id"] == "****901" and row["price"] == 24.5
    assert len(row["user_session"]) == 64 and len(row["brand"]) == 64
    assert rows_of(security.mask_tagged(silver, tags)) == rows_of(security.mask_tagged(stored))
    assert rows_of(security.mask_tagged(stored, groups=["data-engineers"])) == rows_of(silver)
    assert security.mask_tagged(silver, {}).columns == silver.columns


def test_coverage(spark, silver):
    out = security.access_coverage({"events": (silver, "category_l1")}, access_map(spark, GRANTS))
    assert {r["user_name"]: r["visible_rows"] for r in out.collect()} == {
        "ana@shop.example": 7,
        "ben@shop.example": 4,
        "root@shop.example": 12,
    }


def test_audit(spark):
    rows = [("2024-01-01 10:00:00", "a@x", "shop.gold.t"), ("2024-01-01 11:00:00", "a@x", "shop.gold.t"),
            ("2024-01-02 10:00:00", "b@x", "other")]
    df = spark.createDataFrame(rows, "t string, e string, n string").select(
        F.col("t").cast("timestamp").alias("event_time"),
        F.struct(F.col("e").alias("email")).alias("user_identity"),
        F.struct(F.col("n").alias("full_name_arg")).alias("request_params"),
    )
    assert [tuple(r)[1:] for r in security.audit_daily(df, "shop").collect()] == [(2, 1)]


def test_dimensions(silver):
    prices = {r["product_id"]: (r["price"], r["brand"], r["category_l1"]) for r in dims.products_dim(silver).collect()}
    assert prices[52] == (61.75, "lumen", "lighting") and len(prices) == 4
    users = {r["user_id"]: r["total_events"] for r in dims.users_dim(silver).collect()}
    assert users == {901: 6, 902: 3, 903: 3}
    out = dims.enrich(silver, dims.products_dim(silver).filter("product_id <> 47"), "product_id", ["brand"])
    assert out.count() == 12 and out.filter("dim_brand IS NULL").count() == 3
