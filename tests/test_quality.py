from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopstream.operators import quality as q
from shopstream.schema import BRONZE_SCHEMA, RAW_SCHEMA
from tests.conftest import RAW_ROWS, at, bronze_rows, rows_of

maybe = st.none
EVENT = st.tuples(
    st.sampled_from(["", "2019-10-01 00:00:00", "2019-10-02 10:00:00"]),
    st.sampled_from([None, "view", "VIEW", "purchase", "refund", ""]),
    st.sampled_from([None, -1, 0, 1, 2]),
    st.sampled_from([None, -1, 3]),
    st.sampled_from([None, "a.b"]),
    st.sampled_from([None, "x"]),
    st.sampled_from([None, -0.01, 0.0, 100000.0, 100000.01, float("nan")]),
    st.sampled_from([None, 0, 9]),
    st.sampled_from([None, "s"]),
)
few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@few
@given(st.lists(EVENT, min_size=1, max_size=40))
def test_valid_and_quarantined_partition_the_input(spark, rows):
    df = spark.createDataFrame(bronze_rows(rows), BRONZE_SCHEMA)
    kept, gone = q.filter_valid(df), q.quarantined(df)
    parts = rows_of(kept) + rows_of(gone.drop("quarantine_reason"))
    # As text, since NaN does not equal itself.
    assert sorted(map(repr, parts)) == sorted(map(repr, rows_of(df)))
    assert gone.filter("quarantine_reason IS NULL").count() == 0
    report = q.report(df).first()
    assert report["valid_records"] == kept.count() and report["total_records"] == len(rows)


def test_every_reason(spark):
    good = ["2019-10-01 00:00:00", "view", 1, 1, "a", "b", 1.0, 1, "s"]

    def broken(position, value):
        return tuple(value if i == position else v for i, v in enumerate(good))

    cases = {
        "null_event_time": broken(0, ""),
        "null_event_type": broken(1, None),
        "null_product_id": broken(2, None),
        "null_user_id": broken(7, None),
        "null_price": broken(6, None),
        "negative_price": broken(6, -1.0),
        "price_above_max": broken(6, 100000.5),
        "invalid_event_type": broken(1, "refund"),
        "non_positive_id": broken(2, 0),
    }
    df = spark.createDataFrame(bronze_rows(cases.values()), BRONZE_SCHEMA)
    assert [r["quarantine_reason"] for r in q.quarantined(df).collect()] == list(cases)


def test_expectation_counts(dirty):
    counts = {r["expectation"]: (r["passed"], r["failed"]) for r in q.expectation_counts(dirty).collect()}
    assert list(counts) == list(q.EXPECTATIONS)
    assert counts["valid_event_time"] == (8, 1)
    assert counts["price_is_positive"] == (8, 1)
    assert counts["event_type_in_allowed_values"] == (8, 1)
    assert q.expectation_counts(dirty, q.CRITICAL).count() == 3


def test_actions(dirty):
    assert q.apply(dirty, q.EXPECTATIONS, "drop").count() == 6
    warned = q.apply(dirty, q.EXPECTATIONS, "warn")
    assert warned.count() == 9 and warned.filter("size(failed_expectations) > 0").count() == 3
    with pytest.raises(Exception, match="expectation failed: critical_event_time"):
        q.apply(dirty, q.CRITICAL, "fail").count()
    assert q.apply(dirty.filter("event_time IS NOT NULL"), q.CRITICAL, "fail").count() == 8
    with pytest.raises(ValueError):
        q.apply(dirty, q.CRITICAL, "ignore")


def test_flags(spark):
    df = spark.createDataFrame(
        [(None, "view", None, -5.0, 0, None), (at("2019-10-01"), None, 3, None, 4, -1)],
        "event_time timestamp, event_type string, product_id bigint, price double, user_id bigint, category_id bigint",
    )
    out = q.flag_ids(q.flag_price(q.flag_event_type(q.flag_completeness(df)))).collect()
    assert [(r["completeness_issues"], r["is_complete"]) for r in out] == [
        (["event_time", "product_id"], False),
        (["event_type", "price"], False),
    ]
    assert [r["is_valid_event_type"] for r in out] == [True, False]
    assert [r["is_valid_price"] for r in out] == [False, False]
    assert [(r["is_valid_product_id"], r["is_valid_user_id"], r["is_valid_category_id"]) for r in out] == [
        (False, False, True),
        (True, True, False),
    ]


def test_complete_row(raw):
    assert q.flag_completeness(raw).filter("is_complete AND size(completeness_issues) = 0").count() == 6


def test_report(dirty):
    report = q.report_dict(dirty)
    assert report["null_counts"] == {"event_time": 1, "category_code": 1, "brand": 1}
    assert (report["total_records"], report["valid_records"]) == (9, 6)
    assert report["quality_score"] == 66.67 and report["out_of_range_prices"] == 1
    assert report["invalid_event_types"] == 1


def test_report_of_nothing(spark):
    empty = q.report(spark.createDataFrame([], BRONZE_SCHEMA)).first()
    assert (empty["total_records"], empty["quality_score"]) == (0, 0.0)


def test_report_is_one_pass(dirty):
    assert q.report(dirty)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_valid_filter_reaches_the_scan(spark, dirty, tmp_path):
    path = str(tmp_path / "t")
    dirty.write.parquet(path)
    plan = q.filter_valid(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("], ReadSchema")[0]
    assert "In(event_" in pushed and "IsNotNull(price)" in pushed


def test_session_format(spark):
    df = spark.createDataFrame(
        [("0c1a2b3d-0c1a-2b3d-4e5f-0c1a2b3d4e5f",), ("ann-4",), (None,)], "user_session string"
    )
    assert [r[0] for r in df.select(q.is_valid({}, session_format=True)).collect()] == [True, False, False]


def surplus(rows, keys, order):
    """Brute force: all rows but the lowest of each key."""
    groups: dict[tuple, list] = {}
    low = lambda v: (v is not None, v if v is not None else 0)
    for r in rows:
        groups.setdefault(tuple(r[k] for k in keys), []).append(r)
    out = []
    for members in groups.values():
        members.sort(key=lambda r: [low(r[i]) for i in order])
        out += members[1:]
    return Counter(out)


@few
@given(
    st.lists(
        st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, 1, 2]), st.sampled_from([None, 5, 6])),
        max_size=40,
    )
)
def test_duplicate_rows_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, o int, v int")
    got = Counter(tuple(r) for r in q.duplicate_rows(df, ["k"], ["o"]).collect())
    assert got == surplus(rows, [0], [1, 2])


def test_equal_copies_are_listed_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(q, "COPY_BLOCK", 3)
    df = spark.createDataFrame([(1, 1, 1)] * 11 + [(2, 1, 1)] * 4 + [(3, 1, 1)], "k int, o int, v int")
    out = Counter(r["k"] for r in q.duplicate_rows(df, ["k"], ["o"]).collect())
    assert out == {1: 10, 2: 3}


def test_duplicates_when_the_key_is_the_whole_row(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [r["k"] for r in q.duplicate_rows(df, ["k"], []).collect()] == [1]


def test_null_key_counts_as_a_value(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, 1)], "a int, b int")
    assert tuple(q.count_duplicates(df, ["a", "b"]).first()) == (3, 2, 1)


def test_sample_has_no_invalid_rows(spark):
    df = spark.createDataFrame(RAW_ROWS, RAW_SCHEMA)
    assert q.filter_valid(df).count() == 6 and q.quarantined(df).count() == 0


def test_rules_as_plain_sql(dirty):
    named = dirty.agg(*[F.count_if(q.passes(p)).alias(n) for n, p in q.PIPELINE_EXPECTATIONS.items()]).first()
    assert named["valid_price"] == 8
