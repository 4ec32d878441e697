"""Deliveries of any size are written and read by many tasks; the micro-batches stay one a delivery."""

from __future__ import annotations

import os

import pytest

from pyspark.sql import functions as F

from tests.conftest import TESTDATA

from workload import queries

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")


@pytest.fixture
def many_files(spark, monkeypatch, tmp_path):
    """The CSV rows in six files."""
    folder = str(tmp_path / "csv")
    raw = spark.read.option("header", True).csv(queries.csv_folder(spark, TESTDATA))
    raw.repartition(6).write.option("header", True).csv(folder)
    monkeypatch.setattr(queries, "csv_folder", lambda *_: folder)
    return folder


def test_a_part_is_written_by_more_than_one_task(spark, many_files, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        queries._part(spark, TESTDATA, str(tmp_path / "part"), F.lit(True))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    names = [n for n in os.listdir(tmp_path / "part") if n.endswith(".csv")]
    assert len(names) > 1


@pytest.mark.parametrize("name", ["processed_files", "stream_progress"])
def test_one_batch_a_delivery_whatever_its_files(spark, many_files, name):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = queries.QUERIES[name](spark, TESTDATA).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    raw = spark.read.option("header", True).csv(many_files).withColumn("event_time", F.to_timestamp(F.substring("event_time", 1, 19)))
    want = {i: raw.filter(rule).count() for i, rule in enumerate(queries.DELIVERIES)}
    assert {r.batch_id: r.input_rows for r in rows} == want
    if name == "processed_files":
        assert {r.files for r in rows} == {1} and {r.committed for r in rows} == {True}


def test_late_events_come_in_one_batch_a_delivery(spark, many_files, monkeypatch):
    batches = []
    insert = queries.streaming.insert_new_table
    monkeypatch.setattr(queries.streaming, "insert_new_table", lambda *a: batches.append(1) or insert(*a))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        queries.stream_late(spark, TESTDATA)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(batches) == len(queries.LATE_DELIVERIES) == 4
