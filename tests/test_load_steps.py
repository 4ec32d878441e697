"""A load computes each thing once: unique events before the derived columns, no merge of rows that stand alone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from shopstream.operators import state, upsert
from shopstream.operators.silver import deduplicate, to_silver
from shopstream.schema import BRONZE_SCHEMA
from shopstream.sources import tables
from tests.conftest import rows_of

AT = datetime(2021, 6, 1, 12)


def counts():
    per_day = state.Partial(
        lambda events: events.groupBy("user_id", "day").agg(F.count("*").alias("n")),
        lambda rows: rows.groupBy("user_id").agg(F.sum("n").alias("n"), F.count("*").alias("days")),
        {"n": "sum"},
    )
    return state.Kept(("user_id",), F.pmod("user_id", F.lit(2)).cast("int"), {"counts": per_day})


def event(user, product, session, price=1.0, file="a", kind="view", code="x.y"):
    values = dict(
        event_time=AT, event_type=kind, product_id=product, category_id=1, category_code=code, brand="b", price=price,
        user_id=user, user_session=session, ingestion_timestamp=AT, source_file=file, created_at=AT,
    )
    return tuple(values[c] for c in BRONZE_SCHEMA.names)


def test_unique_by_id_is_unique_by_key_and_then_by_id(spark):
    rows = [
        event(1, 23, "s"), event(12, 3, "s"),  # one id, two keys
        event(5, 7, None, 3.0), event(5, 7, "", 2.0), event(5, 7, " ", 4.0, "b"),
        event(6, 7, "t", 2.0, "b"), event(6, 7, "t", 9.0, "a", "VIEW"), event(6, 7, "t", 9.0, "a", "view", "a-b.c"),
        event(0, 7, "t"),
    ]
    bronze = spark.createDataFrame(rows, BRONZE_SCHEMA)
    want = deduplicate(to_silver(bronze, audit=False), ("event_id",))
    found = to_silver(bronze, audit=False, by_id=True)
    assert found.columns == want.columns and rows_of(found) == rows_of(want) and found.count() == 3


def load(spark, rows, root, name):
    events = spark.createDataFrame(rows, "user_id bigint, day string")
    kept = counts()
    slots = state.add_load(kept, events, root, name)
    state.finish_load(kept, events, root, slots, name)
    return sorted(tuple(r) for r in state.aggregates(spark, root).select("user_id", "n", "days").collect())


def test_rows_of_one_load_are_not_merged_those_of_two_are(spark, tmp_path, monkeypatch):
    merged = []
    merge = state.Partial.merge
    monkeypatch.setattr(state.Partial, "merge", lambda self, rows: merged.append(1) or merge(self, rows))
    root = str(tmp_path / "state")
    first = [(1, "a"), (1, "a"), (1, "b"), (2, "a"), (3, None)]
    assert load(spark, first, root, "l1") == [(1, 3, 2), (2, 1, 1), (3, 1, 1)] and not merged
    assert load(spark, first, root, "l1") == [(1, 3, 2), (2, 1, 1), (3, 1, 1)] and not merged  # repeated
    assert load(spark, [(1, "b"), (3, "c"), (4, "a")], root, "l2") == [(1, 4, 2), (2, 1, 1), (3, 2, 2), (4, 1, 1)] and merged


def test_the_times_of_a_batch_may_come_from_cheaper_rows(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", AT), ("b", AT)], "event_id string, event_time timestamp")
    tables.write_full(rows.limit(1), target)
    fresh = upsert.new_rows(rows, target, ("event_id",), unique=True, times=rows.select("event_time"))
    assert [r.event_id for r in fresh.collect()] == ["b"]
    assert "Window" not in fresh._jdf.queryExecution().optimizedPlan().toString()
