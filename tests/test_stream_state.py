"""New columns, late events, file log and progress of streams."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shopstream.operators.bronze import to_bronze
from shopstream.operators.silver import to_silver
from shopstream.schema import RAW_SCHEMA
from shopstream.sources import tables
from shopstream.sources.csv_events import read_events_csv
from shopstream.streaming import events as streaming
from shopstream.streaming import history
from shopstream.streaming.late import all_events, insert_or_set_aside
from shopstream.streaming.ledger import SchemaLedger, widened
from tests.conftest import rows_of


def write(spark, folder, days, users=(1, 2), **extra):
    rows = [
        ((datetime(2021, 6, 1) + timedelta(days=d, hours=u)).strftime("%Y-%m-%d %H:%M:%S UTC"), "view", 3, 5, "a.b", "x", 2.5, u, f"s{u}")
        for d in days
        for u in users
    ]
    df = spark.createDataFrame(rows, RAW_SCHEMA).withColumns({k: F.lit(v) for k, v in extra.items()})
    df.coalesce(1).write.mode("append").option("header", True).csv(folder)
    return len(rows)


def test_a_ledger_takes_in_new_columns(spark, tmp_path):
    folder, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    for extra in ({}, {"coupon": "c1"}, {}, {"coupon": "c2", "channel": "web"}):
        write(spark, folder, [len(extra)], **extra)
        stream = to_bronze(SchemaLedger(spark, checkpoint).read_stream(folder))
        streaming.run_available(streaming.start_append(stream, sink, checkpoint))
    found = tables.read_table(spark, sink, merge_schema=True)
    assert found.count() == 8
    assert rows_of(found.groupBy("coupon", "channel").count(), "coupon", "channel", "count") == sorted([("c1", None, 2), ("c2", "web", 2), (None, None, 4)], key=repr)
    assert SchemaLedger(spark, checkpoint).current().names[-2:] == ["coupon", "channel"]
    versions = SchemaLedger(spark, checkpoint).versions()
    assert [len(v) for v in versions] == sorted(len(v) for v in versions)


@pytest.mark.parametrize("names", [["user_id", "event_time"], [*RAW_SCHEMA.names[:-1], "other"], [*RAW_SCHEMA.names, "a", "a"]])
def test_a_header_that_does_not_fit_is_refused(names):
    with pytest.raises(ValueError, match="some.csv"):
        widened(RAW_SCHEMA, names, "some.csv")


def late_stream(spark, tmp_path, folder, max_files=1):
    target, late, checkpoint = (str(tmp_path / n) for n in ("silver", "late", "check"))
    rows = to_bronze(streaming.read_event_stream(spark, folder, max_files=max_files))
    query = insert_or_set_aside(streaming.silver_stream(rows, audit=False), target, late, checkpoint, "2 days")
    streaming.run_available(query)
    return target, late


def test_late_events_are_set_aside(spark, tmp_path):
    folder = str(tmp_path / "in")
    write(spark, folder, [10, 11])
    write(spark, folder, [20])
    write(spark, folder, [10, 12, 18, 19], users=(1, 2, 3))
    target, late = late_stream(spark, tmp_path, folder)
    silver, aside = tables.read_table(spark, target), tables.read_table(spark, late)
    # Two days before the latest event, day 20 at 2 o'clock: user 2 and 3 of day 18 are in time.
    assert {(r.event_date.day - 1, r.user_id) for r in aside.collect()} == {(10, 3), (12, 1), (12, 2), (12, 3), (18, 1)}
    assert aside.agg(F.min("late_by_seconds")).first()[0] > 2 * 86_400
    whole = to_silver(to_bronze(read_events_csv(spark, folder)), audit=False)
    assert rows_of(all_events(silver, aside), "event_id") == rows_of(whole, "event_id")
    assert silver.join(aside, "event_id").count() == 0
    # Late copies of late events change nothing.
    write(spark, folder, [10, 12], users=(1, 2, 3))
    late_stream(spark, tmp_path, folder)
    assert tables.read_table(spark, late).count() == 5


def test_a_repeated_batch_is_split_as_before(spark, tmp_path):
    folder = str(tmp_path / "in")
    write(spark, folder, [10])
    write(spark, folder, [20])
    write(spark, folder, [12])
    target, late = late_stream(spark, tmp_path, folder)
    before = rows_of(tables.read_table(spark, target), "event_id"), rows_of(tables.read_table(spark, late), "event_id")
    # The last batch ran, but its commit is lost.
    commits = f"{tmp_path}/check/commits"
    tables.drop_path(spark, f"{commits}/2")
    late_stream(spark, tmp_path, folder)
    assert before == (rows_of(tables.read_table(spark, target), "event_id"), rows_of(tables.read_table(spark, late), "event_id"))
    assert len(before[1]) == 2


def test_files_from_the_log(spark, tmp_path):
    folder, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.conf.set("spark.sql.streaming.fileSource.log.compactInterval", "2")
    try:
        for day in range(5):
            write(spark, folder, [day])
        stream = to_bronze(streaming.read_event_stream(spark, folder, max_files=1))
        streaming.run_available(streaming.start_append(stream, sink, checkpoint))
    finally:
        spark.conf.unset("spark.sql.streaming.fileSource.log.compactInterval")
    assert any(n.endswith(".compact") for n in tables.children(spark, f"{checkpoint}/sources/0"))
    log = history.processed_files(spark, checkpoint)
    assert sorted(r.batch_id for r in log.collect()) == list(range(5)) and log.filter("committed").count() == 5
    assert log.select("path").distinct().count() == 5


def test_progress_of_named_queries(spark, tmp_path):
    folder, kept = str(tmp_path / "in"), str(tmp_path / "progress")
    sizes = [write(spark, folder, [0]), write(spark, folder, [1, 2])]
    listener = history.ProgressTable(spark, kept, ("watched",)).attach()
    try:
        for name in ("watched", "other"):
            stream = to_bronze(streaming.read_event_stream(spark, folder, max_files=1))
            query = streaming.start_append(stream, str(tmp_path / name), str(tmp_path / f"check-{name}"), name=name)
            streaming.run_available(query)
        assert listener.wait(2, 30)
    finally:
        listener.detach()
    rows = listener.read().orderBy("batch_id").collect()
    assert [(r.name, r.input_rows) for r in rows if r.input_rows] == [("watched", n) for n in sizes]
