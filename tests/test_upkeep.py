from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from shopstream import session
from shopstream.operators import maintenance as mt
from shopstream.plans import pipeline
from shopstream.sources import tables
from shopstream.sources.csv_events import write_events_csv
from tests.conftest import rows_of


def test_compaction_keeps_rows_and_drops_files(spark, shop, tmp_path):
    path = str(tmp_path / "t")
    tables.append(shop.repartition(12), path)
    before, after = mt.compact(spark, path)
    assert before == 12 and after < before
    assert rows_of(tables.read_table(spark, path), "event_id", "price") == rows_of(shop, "event_id", "price")


def test_compaction_of_partitions(spark, shop, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(3):
        tables.append(shop, path, ["event_type"])
    before, after = mt.compact(spark, path, ["event_type"])
    assert (before > after) and tables.partition_values(spark, path, "event_type") == [
        "cart", "purchase", "remove_from_cart", "view",
    ]
    assert tables.read_table(spark, path).count() == 3 * shop.count()


def test_compaction_of_one_partition(spark, shop, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(3):
        tables.append(shop, path, ["event_type"])
    carts = {f.name for f in (tmp_path / "t" / "event_type=cart").iterdir()}
    before, after = mt.compact(spark, path, ["event_type"], only=["view"])
    assert after < before and {f.name for f in (tmp_path / "t" / "event_type=cart").iterdir()} == carts
    assert tables.read_table(spark, path).count() == 3 * shop.count()


@pytest.mark.parametrize("curve", ["linear", "morton"])
def test_clustering_narrows_the_files(spark, shop, curve):
    wide = shop.select("user_id", "product_id").repartition(8)

    def spread(df):
        per_file = df.groupBy(F.spark_partition_id()).agg((F.max("user_id") - F.min("user_id")).alias("w"))
        return per_file.agg(F.avg("w")).first()[0]

    out = mt.cluster(wide, ["user_id", "product_id"], curve, files=8)
    assert spread(out) < spread(wide) and rows_of(out) == rows_of(wide)


def test_morton_key_interleaves_bits(spark):
    df = spark.createDataFrame([(0, 0), (3, 0), (0, 3), (3, 3)], "x int, y int")
    keys = [r[0] for r in df.select(mt.morton_key(df, ["x", "y"], bits=2)).collect()]
    assert keys == [0, 0b0101, 0b1010, 0b1111]


def test_retention_drops_old_days(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "2024-01-01"), (2, "2024-01-10"), (3, "2024-01-11"), (4, None)]
    df = spark.createDataFrame(rows, "id int, d string").select("id", F.to_date("d").alias("event_date"))
    tables.write_full(df, path, ["event_date"])
    gone = mt.apply_retention(spark, path, 1, datetime.date(2024, 1, 11))
    assert gone == ["2024-01-01"]
    assert rows_of(tables.read_table(spark, path), "id") == [(2,), (3,), (4,)]


def test_statistics(spark, shop):
    shop.select("user_id", "brand").write.mode("overwrite").saveAsTable("measured")
    mt.analyze(spark, "measured", ["user_id"])
    rows = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED measured user_id").collect()}
    assert int(rows["distinct_count"]) > 1
    spark.sql("DROP TABLE measured")


def test_day_filter_prunes_partitions(spark, shop, tmp_path):
    path = str(tmp_path / "t")
    tables.write_full(shop, path, ["event_date"])
    from shopstream.plans.reports import events_between

    plan = events_between(tables.read_table(spark, path), "2024-01-02", "2024-01-03")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text and plan.count() > 0


# table graph

def test_graph_builds_only_what_is_asked(silver):
    out = pipeline.build({"events_cleaned": silver}, ["daily_sales_summary"])
    assert list(out) == ["daily_sales_summary"] and out["daily_sales_summary"].count() == 2


def test_graph_names_what_is_missing(silver):
    with pytest.raises(KeyError, match="source"):
        pipeline.build({}, ["events_raw"])


def test_graph_refuses_circles():
    loop = {n: pipeline.Table((m,), lambda x: x, "") for n, m in (("a", "b"), ("b", "a"))}
    with pytest.raises(ValueError, match="a > b > a"):
        pipeline.build({}, ["a"], loop)


def test_batch_run_is_idempotent(spark, dirty, tmp_path):
    csv, root = str(tmp_path / "csv"), str(tmp_path / "lake")
    write_events_csv(dirty, csv)
    at = pipeline.run_batch(spark, csv, root, as_of="2021-03-15")
    assert set(at) == set(pipeline.TABLES)

    def state():
        skip = ("processed_timestamp", "quarantine_timestamp", "metric_timestamp")
        return {n: rows_of(tables.read_table(spark, p).drop(*skip)) for n, p in at.items()}

    first = state()
    assert {n: len(r) for n, r in first.items()} == {
        "events_raw": 8, "events_cleaned": 6, "events_quarantine": 2, "customer_metrics": 4,
        "product_performance": 5, "daily_sales_summary": 1, "conversion_funnel": 3, "data_quality_metrics": 1,
    }
    pipeline.run_batch(spark, csv, root, as_of="2021-03-15")
    assert state() == first

    # A second file: one late copy in other spelling, one new event of the same day.
    late = dirty.filter("product_id = 80").withColumn("event_type", F.lit("Purchase"))
    new = dirty.filter("product_id = 47").withColumn("user_id", F.lit(9))
    write_events_csv(late.unionByName(new), str(tmp_path / "more"))
    pipeline.run_batch(spark, str(tmp_path / "more"), root, as_of="2021-03-15")
    after = state()
    assert (len(after["events_raw"]), len(after["events_cleaned"])) == (10, 7)
    assert set(first["events_cleaned"]) < set(after["events_cleaned"])


def test_a_load_with_a_slow_clock_is_not_lost(spark, dirty, tmp_path, monkeypatch):
    real = pipeline.to_bronze
    for i, stamp in enumerate(("2021-04-01 10:00:00", "2021-04-01 09:00:00", "2021-04-01 11:00:00")):
        stamped = F.lit(stamp).cast("timestamp")
        monkeypatch.setattr(pipeline, "to_bronze", lambda raw, at=stamped: real(raw, ingested_at=at))
        csv = str(tmp_path / f"csv{i}")
        write_events_csv(dirty.filter("product_id = 80").withColumn("user_id", F.lit(i + 1).cast("bigint")), csv)
        at = pipeline.run_batch(spark, csv, str(tmp_path / "lake"), as_of="2021-04-01")
    assert rows_of(tables.read_table(spark, at["events_cleaned"]), "user_id") == [(1,), (2,), (3,)]


# session

def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
