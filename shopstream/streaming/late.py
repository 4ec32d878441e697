"""Late events go to a table of their own.

A stream that drops copies by a watermark drops late events as well. Here each micro-batch is split instead: events older than the
latest event of earlier batches by more than the delay are written to a late table, the others to silver. Each event
is in one of the two once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopstream.operators.upsert import insert_new, insert_new_table, new_rows
from shopstream.session import scratch_path
from shopstream.sources import tables
from shopstream.streaming.events import ONCE, each_batch


def insert_or_set_aside(
    events: DataFrame,
    target: str,
    late_target: str,
    checkpoint: str,
    delay: str = "1 day",
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Silver events of a stream into ``target``, late ones into ``late_target``, with ``late_by_seconds``.

    Late is what lies more than ``delay`` behind the latest event of all earlier micro-batches. That bound is stored with the
    checkpoint before the batch is written, so a batch that is repeated is split the same way. A late copy of an event that silver has is
    dropped, as is a copy of a late one.
    """
    bounds = f"{checkpoint.rstrip('/')}/latest"

    def split(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        path = scratch_path(spark, "stream-batch")
        batch.write.parquet(path)
        rows = spark.read.schema(batch.schema).parquet(path)
        bound = latest_before(spark, bounds, number)
        latest = rows.agg(F.max(F.unix_micros("event_time"))).first()[0]
        if latest is not None:
            tables.write_text(spark, f"{bounds}/{number:012d}", str(latest))
        late = is_late(bound, delay)
        insert_new_table(rows.filter(~late), target, ("event_id",), ("event_date",))
        behind = (F.lit(bound) - F.unix_micros("event_time")) / 1_000_000 if bound is not None else F.lit(0)
        aside = rows.filter(late).withColumn("late_by_seconds", behind.cast("bigint"))
        if not aside.isEmpty():
            if tables.exists(spark, target):
                aside = new_rows(aside, target, ("event_id",))
            insert_new_table(aside, late_target, ("event_id",), ("event_date",))
        tables.drop_path(spark, path)

    return each_batch(events, split, checkpoint, trigger)


def is_late(bound: int | None, delay: str) -> Column:
    """Whether an event lies more than the delay before a moment in microseconds; none does without one."""
    if bound is None:
        return F.lit(False)
    return F.col("event_time") < F.timestamp_micros(F.lit(bound)) - F.expr(f"INTERVAL {delay}")


def latest_before(spark, folder: str, number: int) -> int | None:
    """Latest event of the batches before this one."""
    names = [n for n in tables.children(spark, folder) if int(n) < number]
    return max((int(tables.read_text(spark, f"{folder}/{n}")) for n in names), default=None)


def all_events(silver: DataFrame, late: DataFrame) -> DataFrame:
    """Both tables as one, for reports that count late events too."""
    return silver.unionByName(insert_new(silver, late.drop("late_by_seconds"), ("event_id",)))
