from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shopstream.operators import upsert as u
from shopstream.sources import tables
from tests.conftest import rows_of

SCHEMA = "id int, day date, v string, ingestion_timestamp int"


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, d string, v string, ingestion_timestamp int").select(
        "id", F.to_date("d").alias("day"), "v", "ingestion_timestamp"
    )


@pytest.fixture
def old(spark):
    return frame(spark, [(1, "2024-01-01", "a", 1), (2, "2024-01-02", "b", 1), (None, "2024-01-02", "n", 1)])


@pytest.fixture
def new(spark):
    return frame(
        spark,
        [(2, "2024-01-02", "B", 2), (3, "2024-01-03", "c", 2), (3, "2024-01-03", "late", 3), (None, "2024-01-02", "N", 2)],
    )


def test_insert_takes_new_keys_once(old, new):
    assert rows_of(u.insert_new(old, new, ["id"]), "id", "v") == [(3, "c")]


def test_upsert_replaces_and_adds(old, new):
    assert rows_of(u.upsert(old, new, ["id"]), "id", "v") == [(1, "a"), (2, "B"), (3, "c"), (None, "N")]


def test_upsert_twice_is_upsert_once(old, new):
    once = u.upsert(old, new, ["id"])
    assert rows_of(u.upsert(once, new, ["id"])) == rows_of(once)


def test_upsert_keeps_new_columns(old, new):
    out = u.upsert(old, new.withColumn("extra", F.lit(1)), ["id"])
    assert rows_of(out.filter("id = 1"), "extra") == [(None,)]


def test_table_upsert_leaves_other_partitions_alone(spark, old, new, tmp_path):
    path = str(tmp_path / "t")
    u.upsert_table(old, path, ["id"], "day")
    before = {f.name for f in (tmp_path / "t" / "day=2024-01-01").iterdir()}
    for _ in range(2):
        u.upsert_table(new, path, ["id"], "day")
    assert {f.name for f in (tmp_path / "t" / "day=2024-01-01").iterdir()} == before
    assert rows_of(tables.read_table(spark, path), "id", "v") == [(1, "a"), (2, "B"), (3, "c"), (None, "N")]


def test_table_upsert_can_move_rows_between_partitions(spark, old, tmp_path):
    path = str(tmp_path / "t")
    u.upsert_table(old, path, ["id"], "day")
    moved = frame(spark, [(1, "2024-01-09", "a2", 2)])
    u.upsert_table(moved, path, ["id"], "day", moves=True)
    out = tables.read_table(spark, path)
    assert rows_of(out.filter("id = 1"), "v") == [("a2",)] and out.count() == 3
    assert tables.partition_values(spark, path, "day") == ["2024-01-02", "2024-01-09"]


def test_table_insert_is_idempotent(spark, dirty, tmp_path):
    path = str(tmp_path / "raw")
    u.insert_new_table(dirty.limit(3), path)
    u.insert_new_table(dirty, path)
    first = rows_of(tables.read_table(spark, path))
    u.insert_new_table(dirty, path)
    assert rows_of(tables.read_table(spark, path)) == first and len(first) == 8


def test_insert_prunes_the_target_by_batch_time(spark, dirty, tmp_path):
    path = str(tmp_path / "raw")
    u.insert_new_table(dirty, path)
    timeless = dirty.filter("event_time IS NULL")
    u.insert_new_table(timeless, path)
    assert tables.read_table(spark, path).count() == 8


def test_full_write_may_read_what_it_replaces(spark, old, tmp_path):
    path = str(tmp_path / "t")
    tables.write_full(old, path, ["day"])
    tables.write_full(tables.read_table(spark, path).filter("id = 1"), path)
    assert rows_of(tables.read_table(spark, path), "id") == [(1,)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_catalog_tables(spark, old, tmp_path):
    assert not tables.exists(spark, "kept_rows")
    tables.write_full(old, "kept_rows", ["day"])
    assert tables.exists(spark, "kept_rows") and tables.read_table(spark, "kept_rows").count() == 3
    tables.append(old, "kept_rows", ["day"])
    assert spark.table("kept_rows").count() == 6
    spark.sql("DROP TABLE kept_rows")


def test_external_table(spark, old, tmp_path):
    path = str(tmp_path / "ext")
    tables.write_full(old, path, ["day"])
    assert tables.register_external(spark, "outside", path).count() == 3
    spark.sql("DROP TABLE outside")
    assert tables.exists(spark, path)


def test_files_of_different_width_read_as_one(spark, old, tmp_path):
    path = str(tmp_path / "t")
    tables.append(old, path)
    tables.append(old.withColumn("extra", F.lit("x")), path)
    out = tables.read_table(spark, path, merge_schema=True)
    assert out.filter("extra IS NULL").count() == 3 and out.count() == 6
