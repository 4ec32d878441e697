from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.operators.bronze import to_bronze
from shopstream.operators.silver import to_quarantine, to_silver
from shopstream.schema import BRONZE_SCHEMA, RAW_SCHEMA
from shopstream.sources import tables
from shopstream.sources.csv_events import read_events_csv
from shopstream.streaming import events as streaming
from tests.conftest import DIRTY_ROWS, rows_of

HEAD = ",".join(RAW_SCHEMA.names)
VOLATILE = ("ingestion_timestamp", "created_at", "processed_timestamp", "quarantine_timestamp", "source_file")


def put(folder, name, rows, head=HEAD):
    folder.mkdir(exist_ok=True)
    lines = [",".join("" if v is None else str(v) for v in r) for r in rows]
    (folder / name).write_text("\n".join([head, *lines]) + "\n")


def text_rows(rows):
    return [(f"{r[0]} UTC" if r[0] else None, *r[1:]) for r in rows]


@pytest.fixture
def place(tmp_path):
    put(tmp_path / "in", "a.csv", text_rows(DIRTY_ROWS))
    return tmp_path


def bronze_of(spark, place, **kwargs):
    return to_bronze(streaming.read_event_stream(spark, str(place / "in"), **kwargs))


def same(stream_table, batch):
    names = [c for c in batch.columns if c not in VOLATILE]
    assert rows_of(stream_table, *names) == rows_of(batch, *names)


def test_stream_equals_batch_and_takes_files_once(spark, place):
    target, check = str(place / "out"), str(place / "check")

    def drain():
        query = streaming.start_append(bronze_of(spark, place), target, check, name="bronze")
        assert streaming.run_available(query, 60)
        return query

    drain()
    batch = to_bronze(read_events_csv(spark, str(place / "in")))
    same(tables.read_table(spark, target), batch)
    drain()
    same(tables.read_table(spark, target), batch)
    put(place / "in", "b.csv", text_rows(DIRTY_ROWS[:1]))
    query = drain()
    out = tables.read_table(spark, target)
    assert out.count() == 10
    files = [r[0].rsplit("/", 1)[1] for r in streaming.processed_files(out).collect()]
    assert files == ["a.csv", "b.csv"]
    state = streaming.progress(query)
    assert state["is_active"] is False and state["input_rows"] == 1 and not streaming.stop(query)
    assert "event_type=view" in {p.name for p in (place / "out").iterdir()}


def test_silver_stream_equals_batch(spark, place):
    query = streaming.start_append(
        streaming.silver_stream(bronze_of(spark, place), "1 day"), str(place / "out"), str(place / "check"), ["event_date"]
    )
    streaming.run_available(query)
    same(tables.read_table(spark, str(place / "out")), to_silver(to_bronze(read_events_csv(spark, str(place / "in")))))


def test_silver_stream_drops_copies_of_later_batches(spark, place):
    for name in ("a.csv", "b.csv"):
        put(place / "in", name, text_rows(DIRTY_ROWS))
    query = streaming.start_append(
        streaming.silver_stream(bronze_of(spark, place, max_files=1), "1 day"), str(place / "out"), str(place / "check"), []
    )
    streaming.run_available(query)
    assert tables.read_table(spark, str(place / "out")).count() == 6


def test_quarantine_stream_is_the_complement(spark, place):
    query = streaming.start_append(
        streaming.quarantine_stream(bronze_of(spark, place)), str(place / "out"), str(place / "check"), []
    )
    streaming.run_available(query)
    out = tables.read_table(spark, str(place / "out"))
    same(out, to_quarantine(to_bronze(read_events_csv(spark, str(place / "in")))))
    assert out.filter("quarantine_timestamp IS NULL").count() == 0


def test_upsert_stream_merges_batches(spark, place):
    changed = [(*r[:6], 1.0, *r[7:]) for r in text_rows(DIRTY_ROWS[:1])]
    put(place / "in", "b.csv", changed)
    rows = streaming.silver_stream(bronze_of(spark, place, max_files=1), dedup_delay=None)
    query = streaming.upsert_stream(rows, str(place / "out"), str(place / "check"))
    streaming.run_available(query)
    out = tables.read_table(spark, str(place / "out"))
    assert out.count() == 6 and out.select("event_id").distinct().count() == 6


def test_insert_stream_adds_new_keys_only(spark, place):
    put(place / "in", "b.csv", text_rows(DIRTY_ROWS))
    query = streaming.insert_stream(bronze_of(spark, place, max_files=1), str(place / "out"), str(place / "check"))
    streaming.run_available(query)
    assert tables.read_table(spark, str(place / "out")).count() == 8


def test_new_column_after_restart(spark, place):
    target, check = str(place / "out"), str(place / "check")
    streaming.run_available(streaming.start_append(bronze_of(spark, place), target, check))
    wide = T.StructType([*RAW_SCHEMA, T.StructField("channel", T.StringType())])
    put(place / "in", "b.csv", [(*text_rows(DIRTY_ROWS[:1])[0], "app")], HEAD + ",channel")
    streaming.run_available(streaming.start_append(bronze_of(spark, place, schema=wide), target, check))
    out = tables.read_table(spark, target, merge_schema=True)
    assert rows_of(out.filter("channel IS NOT NULL"), "channel") == [("app",)] and out.count() == 10


def test_continuous_query_can_be_watched_and_stopped(spark, place):
    query = streaming.start_append(
        bronze_of(spark, place), str(place / "out"), str(place / "check"), trigger={"processingTime": "1 second"}
    )
    query.processAllAvailable()
    assert not streaming.run_available(query, 1)
    assert streaming.progress(query)["is_active"] and streaming.stop(query)
    assert tables.read_table(spark, str(place / "out")).count() == 9


def test_failure_is_reported(spark, place):
    bad = bronze_of(spark, place).withColumn("brand", F.raise_error(F.lit("broken")))
    query = streaming.start_append(bad, str(place / "out"), str(place / "check"))
    with pytest.raises(Exception, match="broken"):
        streaming.run_available(query)


def test_stream_schema(spark, place):
    assert set(bronze_of(spark, place).columns) == set(BRONZE_SCHEMA.names)


def test_late_events_arrive_once(spark, tmp_path):
    """Files out of date order: an event far behind the others is new all the same."""
    folder = tmp_path / "in"
    folder.mkdir()
    days = ["2021-11-20", "2021-11-21", "2021-10-05", "2021-11-22", "2021-10-05"]
    for i, day in enumerate(days):
        put(folder, f"{i}.csv", [(f"{day} 10:00:00 UTC", "view", 70 + len(day), 1, "a.b", "c", 1.0, 400 + int(day[-2:]), "s")])
    events = streaming.silver_stream(bronze_of(spark, tmp_path, max_files=1))
    streaming.run_available(streaming.insert_silver(events, str(tmp_path / "out"), str(tmp_path / "check")))
    out = tables.read_table(spark, str(tmp_path / "out"))
    assert sorted(str(r.event_date) for r in out.collect()) == sorted(set(days))
