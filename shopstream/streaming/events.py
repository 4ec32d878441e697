"""Incremental ingest with Structured Streaming.

Bronze and silver use the batch functions. State is kept only by the
optional de-duplication, and the watermark bounds it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shopstream.operators.silver import to_quarantine, to_silver
from shopstream.operators.upsert import insert_new_table, upsert_table
from shopstream.schema import EVENT_KEY, MALFORMED, RAW_SCHEMA
from shopstream.sources.csv_events import with_malformed

ONCE = {"availableNow": True}


def read_event_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_SCHEMA,
    max_files: int | None = None,
    keep_malformed: bool = False,
    **options: str,
) -> DataFrame:
    """New CSV files of a folder as they appear.

    ``max_files`` bounds a micro-batch. To take in new columns restart with a wider schema, see
    ``streaming.ledger``: the sink's Parquet files may differ and are read with ``merge_schema``. ``keep_malformed`` is
    as in ``read_events_csv``.
    """
    if keep_malformed:
        schema, options = with_malformed(schema), {**options, "columnNameOfCorruptRecord": MALFORMED}
    reader = spark.readStream.schema(schema).option("header", True).option("pathGlobFilter", "*.csv")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.options(**options).csv(path)


def start_append(
    df: DataFrame,
    target: str,
    checkpoint: str,
    partition_by: Sequence[str] = ("event_type",),
    trigger: Mapping[str, object] = ONCE,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet table, each input row once.

    ``trigger`` is ``{"availableNow": True}`` to drain what is there and stop, or
    ``{"processingTime": "1 minute"}`` to keep running.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def silver_stream(bronze: DataFrame, dedup_delay: str | None = None, audit: bool = True) -> DataFrame:
    """Cleaned events of a stream, copies included: ``insert_silver`` writes each event once.

    With ``dedup_delay`` the stream itself drops copies, from a state that holds the ids of that delay. Then
    **every event later than the delay is dropped too, whether seen before or not**, so a backfill needs the
    default. Rows without a time are rejected before the watermark sees them.
    """
    out = to_silver(bronze, dedup=False, audit=audit)
    if dedup_delay:
        out = out.withWatermark("event_time", dedup_delay).dropDuplicatesWithinWatermark(["event_id"])
    return out


def quarantine_stream(bronze: DataFrame) -> DataFrame:
    """Rejected events of a stream, with time and reason."""
    return to_quarantine(bronze, F.current_timestamp())


def insert_silver(
    events: DataFrame, target: str, checkpoint: str, trigger: Mapping[str, object] = ONCE
) -> StreamingQuery:
    """Add each micro-batch's new events to a silver table, however late they come.

    The first copy to arrive stays. A key lookup reads the table's ids within the times of the batch only, and
    files already written keep as they are.
    """
    return insert_stream(events, target, checkpoint, ("event_id",), ("event_date",), trigger)


def upsert_stream(
    df: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str] = ("event_id",),
    partition_column: str = "event_date",
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Merge each micro-batch into a table by key; replaying a batch changes nothing."""

    def merge(batch: DataFrame, _: int) -> None:
        upsert_table(batch, target, keys, partition_column)

    return each_batch(df, merge, checkpoint, trigger)


def insert_stream(
    df: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str] = EVENT_KEY,
    partition_by: Sequence[str] = ("event_type",),
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Add each micro-batch's new keys to a table; replaying a batch changes nothing."""

    def add(batch: DataFrame, _: int) -> None:
        insert_new_table(batch, target, keys, partition_by)

    return each_batch(df, add, checkpoint, trigger)


def each_batch(df: DataFrame, work, checkpoint: str, trigger: Mapping[str, object]) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_available(query: StreamingQuery, timeout: int | None = None) -> bool:
    """Wait for a query; true once it has ended. A failure in it is raised here."""
    if timeout is None:
        query.awaitTermination()
        return True
    return bool(query.awaitTermination(timeout))


def progress(query: StreamingQuery) -> dict:
    """State of a query and the figures of its last micro-batch."""
    last = query.lastProgress or {}
    return {
        "query_id": str(query.id),
        "name": query.name,
        "is_active": query.isActive,
        "status": dict(query.status),
        "batch_id": last.get("batchId"),
        "input_rows": last.get("numInputRows", 0),
        "rows_per_second": last.get("processedRowsPerSecond", 0.0),
    }


def stop(query: StreamingQuery) -> bool:
    """Stop a running query; false if it had ended already."""
    running = query.isActive
    if running:
        query.stop()
    return running


def processed_files(bronze: DataFrame) -> DataFrame:
    """Files whose rows have reached the table."""
    return bronze.select("source_file").distinct().orderBy("source_file")
