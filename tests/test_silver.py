from __future__ import annotations

import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from shopstream.operators import silver as s
from shopstream.schema import BRONZE_SCHEMA, SILVER_COLUMNS
from tests.conftest import DIRTY_ROWS, at, bronze_rows, by_key, rows_of


@pytest.fixture
def cleaned(dirty):
    return s.to_silver(dirty)


def test_columns_and_rows(cleaned):
    assert cleaned.columns == [name for name, _ in SILVER_COLUMNS]
    assert [t for _, t in cleaned.dtypes] == [t for _, t in SILVER_COLUMNS]
    assert cleaned.count() == 6


def test_upper_case_type_is_accepted(cleaned):
    assert by_key(cleaned, "product_id")[47]["event_type"] == "cart"


def test_defaults_and_trimming(cleaned):
    rows = by_key(cleaned, "product_id")
    assert [rows[p]["category_code"] for p in (52, 60, 47)] == ["unknown", "unknown", "garden.seeds"]
    assert [rows[p]["brand"] for p in (52, 60, 47)] == ["unknown", "unknown", "sproutco"]
    assert cleaned.filter("category_code IS NULL OR brand IS NULL OR trim(brand) = ''").count() == 0


def test_category_levels(cleaned):
    rows = by_key(cleaned.dropDuplicates(["product_id"]), "product_id")
    levels = {p: (r["category_l1"], r["category_l2"], r["category_l3"]) for p, r in rows.items()}
    assert levels[31] == ("garden", "tools", "rake")
    assert levels[80] == ("kitchen", None, None)
    assert levels[52] == ("unknown", None, None)


def test_date_parts(spark):
    df = spark.createDataFrame([(at("2019-10-06 23:59:59"),)], "event_time timestamp")
    row = s.derive_dates(df).first()
    assert tuple(row)[1:] == (date(2019, 10, 6), 23, 1, 6, 10, 2019, 40)


def test_event_id_is_the_digest_of_the_key(spark, cleaned):
    assert cleaned.filter("event_id IS NULL").count() == 0
    row = cleaned.filter("event_type = 'cart' AND product_id = 31").first()
    text = "2021-03-10 06:31:30" + "901" + "31" + "ann-3" + "cart"
    assert row["event_id"] == hashlib.sha256(text.encode()).hexdigest()


def test_missing_session_has_a_stable_id_and_one_row(spark):
    base = list(DIRTY_ROWS[0])
    rows = [tuple([*base[:8], x]) for x in (None, "", "  ", None)]
    out = s.to_silver(spark.createDataFrame(bronze_rows(rows), BRONZE_SCHEMA))
    assert out.count() == 1 and out.first()["event_id"] is not None


def test_separator_keeps_part_borders_apart(spark):
    a, b = list(DIRTY_ROWS[0]), list(DIRTY_ROWS[0])
    a[7], a[2], b[7], b[2] = 12, 34, 1, 234
    df = spark.createDataFrame(bronze_rows([tuple(a), tuple(b)]), BRONZE_SCHEMA)
    assert s.to_silver(df).select("event_id").distinct().count() == 1
    assert s.to_silver(df, sep="|").select("event_id").distinct().count() == 2


def test_first_delivery_survives(spark):
    rows = [
        *bronze_rows([DIRTY_ROWS[0]], at("2019-11-02 00:00:00"), "late.csv"),
        *bronze_rows([DIRTY_ROWS[0]], at("2019-11-01 00:00:00"), "early.csv"),
    ]
    out = s.to_silver(spark.createDataFrame(rows, BRONZE_SCHEMA))
    assert [r["source_file"] for r in out.collect()] == ["early.csv"]


def test_dedup_order_is_a_choice(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, "c")], "k int, o int, v string")
    assert rows_of(s.deduplicate(df, ["k"], ["o"]), "k", "v") == [(1, "a"), (2, "c")]


def test_silver_and_quarantine_add_up(dirty):
    kept = s.to_silver(dirty, dedup=False)
    gone = s.to_quarantine(dirty)
    assert kept.count() + gone.count() == dirty.count()
    assert rows_of(gone, "product_id", "quarantine_reason") == [
        (53, "null_event_time"),
        (75, "negative_price"),
    ]
    assert gone.columns == [*dirty.columns, "quarantine_reason"]


def test_quarantine_keeps_rows_as_delivered(dirty):
    odd = dirty.withColumn("event_type", F.lit(" Refund "))
    out = s.to_quarantine(odd, F.current_timestamp())
    assert {r["event_type"] for r in out.collect()} == {" Refund "}
    assert "quarantine_timestamp" in out.columns


def test_dedup_prunes_copies_before_the_shuffle(dirty):
    plan = s.to_silver(dirty)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")


def test_streaming_form_has_no_window(dirty):
    plan = s.to_silver(dirty, dedup=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
