from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream import schema
from shopstream.operators.bronze import parse_event_time, to_bronze
from shopstream.operators.profile import null_counts, profile_csv
from shopstream.operators.quality import count_duplicates
from shopstream.sources.csv_events import read_events_csv, write_events_csv
from tests.conftest import DIRTY_ROWS, RAW_ROWS, bronze_rows, rows_of


def test_times_are_parsed(raw):
    out = to_bronze(raw, audit=False)
    assert out.schema["event_time"].dataType == T.TimestampType()
    assert out.filter("event_time IS NULL").count() == 0
    assert out.agg(F.min("event_time")).first()[0] == datetime(2021, 3, 8, 7, 14, 9)


def test_unreadable_time_gives_null(spark):
    df = spark.createDataFrame([("2019-13-45 UTC",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(parse_event_time("t")).collect()] == [None, None, None]


def test_text_is_trimmed_and_absence_kept(spark, raw):
    padded = raw.withColumn("brand", F.concat(F.lit("  "), "brand", F.lit(" ")))
    assert rows_of(to_bronze(padded, audit=False), "brand") == rows_of(raw, "brand")


def test_expected_dirt_of_the_sample(raw):
    out = to_bronze(raw, audit=False)
    assert out.count() == len(RAW_ROWS)
    kinds = {r[0] for r in out.select("event_type").distinct().collect()}
    assert kinds == {"view", "cart", "remove_from_cart", "purchase"} and kinds <= set(schema.EVENT_TYPES)
    gaps = null_counts(out).first()
    assert (gaps["category_code"], gaps["brand"], gaps["event_time"]) == (1, 3, 0)


def test_files_get_lineage(spark, dirty, tmp_path):
    path = str(tmp_path / "csv")
    write_events_csv(dirty, path)
    out = to_bronze(read_events_csv(spark, path))
    assert set(schema.BRONZE_SCHEMA.names) == set(out.columns)
    assert out.filter("ingestion_timestamp IS NULL OR source_file IS NULL OR created_at IS NULL").count() == 0
    assert all(r[0].endswith(".csv") for r in out.select("source_file").distinct().collect())


def test_round_trip_through_files(spark, dirty, tmp_path):
    path = str(tmp_path / "csv")
    write_events_csv(dirty, path)
    out = to_bronze(read_events_csv(spark, path))
    want = to_bronze(
        dirty.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")), audit=False
    ).withColumn("category_code", F.nullif("category_code", F.lit(""))).withColumn(
        "brand", F.nullif("brand", F.lit(""))
    )
    names = schema.RAW_SCHEMA.names
    assert rows_of(out, *names) == rows_of(want, *names)


def test_only_csv_files_are_read_and_bad_numbers_become_null(spark, tmp_path):
    head = ",".join(schema.RAW_SCHEMA.names)
    (tmp_path / "a.csv").write_text(f"{head}\n2019-10-01 00:00:00 UTC,view,x1,1,a.b,c,1.5,7,s\n")
    (tmp_path / "notes.txt").write_text("not an event\n")
    rows = read_events_csv(spark, str(tmp_path)).collect()
    assert len(rows) == 1 and rows[0]["product_id"] is None and rows[0]["user_id"] == 7


def test_fixed_load_time(spark, dirty, tmp_path):
    path = str(tmp_path / "csv")
    write_events_csv(dirty, path)
    when = F.lit("2024-01-01").cast("timestamp")
    out = to_bronze(read_events_csv(spark, path), ingested_at=when)
    assert {r[0] for r in out.select("ingestion_timestamp").collect()} == {datetime(2024, 1, 1)}


def test_duplicate_count(spark):
    rows = [DIRTY_ROWS[0], DIRTY_ROWS[0], DIRTY_ROWS[1]]
    df = spark.createDataFrame(bronze_rows(rows), schema.BRONZE_SCHEMA)
    assert tuple(count_duplicates(df).first()) == (3, 2, 1)


def test_column_check(raw):
    assert schema.check_columns(raw, schema.RAW_SCHEMA.names) == (True, [], [])
    ok, missing, extra = schema.check_columns(raw.drop("brand").withColumn("x", F.lit(1)), schema.RAW_SCHEMA.names)
    assert (ok, missing, extra) == (False, ["brand"], ["x"])
    assert schema.check_columns(raw.withColumn("x", F.lit(1)), schema.RAW_SCHEMA.names)[0]


def test_type_names():
    assert schema.type_of("price") == "double" and schema.type_of("nothing") == "string"
    assert schema.RAW_SCHEMA["price"].metadata["comment"]


def test_profile_counts_rows_and_gaps_per_file(spark, tmp_path):
    head = ",".join(schema.RAW_SCHEMA.names)
    line = "2019-10-01 00:00:00 UTC,view,1,1,,c,1.5,7,s\n"
    (tmp_path / "a.csv").write_text(f"{head}\n{line}{line}")
    (tmp_path / "b.csv").write_text(f"{head}\n{line}")
    out = profile_csv(spark, str(tmp_path)).collect()
    assert [(r["source_file"], r["row_count"], r["null_category_code"], r["null_brand"]) for r in out] == [
        ("a.csv", 2, 2, 0),
        ("b.csv", 1, 1, 0),
    ]
