"""Gold kept by state: loads in any order, repeated and broken off ones, touched slots only."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shopstream.operators import audience
from shopstream.operators.state import MERGED, aggregates_path
from shopstream.operators.silver import to_silver
from shopstream.operators.bronze import to_bronze
from shopstream.plans import customer, daily, funnel, pipeline, product
from shopstream.schema import RAW_SCHEMA
from shopstream.sources import tables
from shopstream.sources.csv_events import read_events_csv
from shopstream.sources.journal import Journal
from tests.conftest import rows_of

AS_OF = "2021-06-30"
SKIP = ("processed_timestamp", "slot", "load", "quarantine_timestamp", "metric_timestamp")


def deliver(spark, folder, seed, days, n=60, broken=0):
    """Random events of some days as one CSV file."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        at = datetime(2021, 6, 1) + timedelta(days=rng.choice(days), seconds=rng.randrange(86_400))
        product_id = rng.randrange(1, 12)
        rows.append(
            (
                at.strftime("%Y-%m-%d %H:%M:%S UTC"),
                rng.choice(["view", "view", "cart", "remove_from_cart", "purchase", "PURCHASE"]),
                product_id,
                500 + product_id % 3,
                [None, "tools.saw", "garden.seeds.herbs"][product_id % 3],
                [None, "Acme", "birch"][product_id % 3],
                round(rng.uniform(1, 200), 2),
                rng.randrange(1, 9),
                f"s{rng.randrange(12)}" if rng.random() < 0.9 else None,
            )
        )
    rows += [(None, "view", 1, 1, None, None, 1.0, 1, f"bad{seed}-{i}") for i in range(broken)]
    spark.createDataFrame(rows, RAW_SCHEMA).coalesce(1).write.mode("append").option("header", True).csv(folder)
    return folder


def gold(spark, at):
    return {n: rows_of(tables.read_table(spark, p).drop(*SKIP)) for n, p in at.items() if tables.exists(spark, p)}


def expected(spark, folders):
    """Every table from all events at once."""
    raw = to_bronze(read_events_csv(spark, folders[0]))
    for f in folders[1:]:
        raw = raw.unionByName(to_bronze(read_events_csv(spark, f)))
    silver = to_silver(raw, audit=False).cache()
    return {
        "customer_metrics": rows_of(customer.customer_metrics(silver, AS_OF)),
        "product_performance": rows_of(product.product_performance(silver)),
        "daily_sales_summary": rows_of(daily.daily_sales_summary(silver)),
        "conversion_funnel": rows_of(funnel.conversion_funnel(silver)),
    }


@pytest.fixture
def three(spark, tmp_path):
    """Deliveries of days 5-9, of earlier days, and of days between; the last repeats the first file."""
    folders = [str(tmp_path / n) for n in "abc"]
    deliver(spark, folders[0], 1, range(5, 10), broken=2)
    deliver(spark, folders[1], 2, range(0, 3))
    deliver(spark, folders[2], 3, range(2, 7), broken=1)
    deliver(spark, folders[2], 1, range(5, 10))
    return folders


def test_loads_add_up(spark, three, tmp_path):
    root = str(tmp_path / "lake")
    for folder in three:
        at = pipeline.run_batch(spark, folder, root, AS_OF, buckets=3)
    found, want = gold(spark, at), expected(spark, three)
    for name, rows in want.items():
        assert found[name] == rows, name
    assert len(found["events_quarantine"]) == 3
    again = pipeline.run_batch(spark, three[1], root, AS_OF, buckets=3)
    assert gold(spark, again) == found
    assert Journal(spark, root).open() == [] and len(Journal(spark, root).closed()) == 4


def modified(spark, path):
    return {f: tables.files(spark, f"{path}/{f}", ".parquet") for f in tables.children(spark, path) if "=" in f}


def test_only_touched_slots_are_rewritten(spark, tmp_path):
    root = str(tmp_path / "lake")
    at = pipeline.run_batch(spark, deliver(spark, str(tmp_path / "a"), 1, range(10), 200), root, AS_OF, buckets=16)
    watched = {
        "conversion_funnel": at["conversion_funnel"],
        "days": aggregates_path(f"{root}/_state/days"),
        "customers": aggregates_path(f"{root}/_state/customers-16"),
        "customer_metrics": at["customer_metrics"],
        "events_cleaned": at["events_cleaned"],
    }
    before = {n: modified(spark, p) for n, p in watched.items()}
    one = spark.createDataFrame(
        [("2021-06-04 12:00:00 UTC", "purchase", 3, 500, "tools.saw", "acme", 5.0, 2, "s1")], RAW_SCHEMA
    )
    one.coalesce(1).write.option("header", True).csv(str(tmp_path / "b"))
    pipeline.run_batch(spark, str(tmp_path / "b"), root, AS_OF, buckets=16)
    changed = {n: {f for f, files in modified(spark, p).items() if files != before[n].get(f)} for n, p in watched.items()}
    assert changed["conversion_funnel"] == {"event_date=2021-06-04"} and changed["days"] == {"slot=2021-06-04"}
    assert len(changed["customers"]) == 1 and changed["customer_metrics"] == changed["customers"]
    assert changed["events_cleaned"] == {"event_date=2021-06-04"}
    # Recency from another day concerns every customer.
    pipeline.run_batch(spark, str(tmp_path / "b"), root, "2021-07-05", buckets=16)
    later = tables.read_table(spark, at["customer_metrics"])
    assert later.agg(F.min("days_since_last_activity")).first()[0] >= 25


@pytest.mark.parametrize("step", ["_kept", "_customers"])
def test_a_load_that_breaks_off_is_completed(spark, three, tmp_path, monkeypatch, step):
    root, calls = str(tmp_path / "lake"), []
    real = getattr(pipeline.Lake, step)

    def fails_once(self, *args):
        calls.append(step)
        if len(calls) == 2:
            if step == "_kept":  # after the state is written
                real(self, *args)
            raise OSError("disk gone")
        return real(self, *args)

    monkeypatch.setattr(pipeline.Lake, step, fails_once)
    pipeline.run_batch(spark, three[0], root, AS_OF, buckets=1)
    with pytest.raises(OSError):
        pipeline.run_batch(spark, three[1], root, AS_OF, buckets=1)
    assert len(Journal(spark, root).open()) == 1
    at = pipeline.run_batch(spark, three[2], root, AS_OF, buckets=1)
    found, want = gold(spark, at), expected(spark, three)
    assert all(found[n] == rows for n, rows in want.items()) and Journal(spark, root).open() == []


def test_an_append_that_breaks_off_loses_nothing(spark, three, tmp_path, monkeypatch):
    """Half of a load's events reach silver before the failure."""
    root, real = str(tmp_path / "lake"), tables.append
    pipeline.run_batch(spark, three[0], root, AS_OF, buckets=3)

    def half(df, target, partition_by=()):
        real(df.filter("product_id % 2 = 0") if "events_cleaned" in target else df, target, partition_by)
        if "events_cleaned" in target:
            raise OSError("executor gone")

    monkeypatch.setattr(tables, "append", half)
    with pytest.raises(OSError):
        pipeline.run_batch(spark, three[1], root, AS_OF, buckets=3)
    monkeypatch.setattr(tables, "append", real)
    at = pipeline.run_batch(spark, three[2], root, AS_OF, buckets=3)
    found, want = gold(spark, at), expected(spark, three)
    assert all(found[n] == rows for n, rows in want.items())


def test_compaction_of_state(spark, three, tmp_path):
    root = str(tmp_path / "lake")
    for folder in three:
        at = pipeline.run_batch(spark, folder, root, AS_OF, buckets=3, compact_after=2)
    state = tables.read_table(spark, f"{root}/_state/days/grains")
    assert state.filter(F.col("load") == MERGED).count() > 0 and state.select("load").distinct().count() == 2
    found, want = gold(spark, at), expected(spark, three)
    assert all(found[n] == rows for n, rows in want.items())


def test_an_empty_delivery(spark, tmp_path):
    root = str(tmp_path / "lake")
    spark.createDataFrame([], RAW_SCHEMA).coalesce(1).write.option("header", True).csv(str(tmp_path / "none"))
    pipeline.run_batch(spark, str(tmp_path / "none"), root, AS_OF, buckets=3)
    at = pipeline.run_batch(spark, deliver(spark, str(tmp_path / "a"), 1, range(3)), root, AS_OF, buckets=3)
    first = gold(spark, at)
    pipeline.run_batch(spark, str(tmp_path / "none"), root, AS_OF, buckets=3)
    assert gold(spark, at) == first and first["conversion_funnel"]


def test_malformed_records_reach_quarantine(spark, tmp_path):
    folder, root = tmp_path / "a", str(tmp_path / "lake")
    deliver(spark, str(folder), 1, range(3))
    head = ",".join(RAW_SCHEMA.names)
    lines = ["2021-06-01 00:00:00 UTC,view,1,1,a,b,cheap,5,s", "only three,fields,here", "2021-06-01 00:00:00 UTC,view,1,1,a,b,1.0,5,s,extra"]
    (folder / "broken.csv").write_text("\n".join([head, *lines]) + "\n")
    at = pipeline.run_batch(spark, str(folder), root, AS_OF, buckets=3, keep_malformed=True)
    pipeline.run_batch(spark, str(folder), root, AS_OF, buckets=3, keep_malformed=True)
    kept = tables.read_table(spark, at["events_quarantine"])
    assert sorted(r.malformed_line for r in kept.collect()) == sorted(lines)
    assert {r.quarantine_reason for r in kept.collect()} == {"malformed"}
    assert "malformed_line" not in tables.read_table(spark, at["events_cleaned"]).columns


# audiences

def test_days_merge_into_periods(spark, three, tmp_path):
    root = str(tmp_path / "lake")
    for folder in three[:2]:
        at = pipeline.run_batch(spark, folder, root, AS_OF, buckets=3)
    silver = tables.read_table(spark, at["events_cleaned"])
    bought = F.col("event_type") == "purchase"
    want = silver.groupBy(audience.week_of().alias("period")).agg(
        F.count_distinct("user_id").alias("users"),
        F.count_distinct(F.when(bought, F.col("user_id"))).alias("buyers"),
        F.count_distinct("product_id").alias("products"),
        F.count_distinct(F.when(bought, F.col("product_id"))).alias("products_sold"),
    )
    assert rows_of(pipeline.period_audience(spark, root, audience.week_of())) == rows_of(want)
    sketched = pipeline.period_audience(spark, root, audience.month_of(), exact=False).first()
    assert sketched.sessions == silver.select("user_session").distinct().filter("user_session IS NOT NULL").count()


def test_bitmaps_of_large_and_negative_ids(spark):
    ids = [0, 1, -1, 32_767, 32_768, 32_769, -40_000, 2**40, 2**40 + 1]
    rows = [(datetime(2021, 6, 1 + i % 2), k, "purchase" if i % 3 else "view", i, None) for i, k in enumerate(ids)]
    events = spark.createDataFrame(rows, "event_date date, user_id bigint, event_type string, product_id bigint, user_session string")
    days = audience.day_bitmaps(events)
    merged = audience.merge_bitmaps(days, days)
    found = audience.exact_distincts(merged, audience.month_of()).first()
    assert (found.users, found.buyers, found.products) == (9, 6, 9)
    sketches = audience.merge_sketches(audience.day_sketches(events), audience.day_sketches(events))
    assert audience.sketched_distincts(sketches, audience.month_of()).first().users == 9


# partition swaps

def test_partitions_are_swapped_in(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a b"), (2, "x/y"), (3, None)], "v int, k string")
    tables.swap_partitions(rows, path, "k")
    there = tables.read_table(spark, path)
    tables.swap_partitions(there.filter("k = 'x/y' OR k IS NULL").selectExpr("v * 10 AS v", "k"), path, "k")
    assert rows_of(tables.read_table(spark, path), "v", "k") == sorted([(1, "a b"), (20, "x/y"), (30, None)], key=repr)
    assert [n for n in tables.children(spark, str(tmp_path)) if "__new_" in n] == []
