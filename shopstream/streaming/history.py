"""What a stream has done: files by micro-batch, from the checkpoint, and progress, kept as a table."""

from __future__ import annotations

import datetime
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from shopstream.sources import tables

LOG_ENTRY = "path string, timestamp bigint, batchId bigint"
PROGRESS = (
    "query_id string, run_id string, name string, batch_id bigint, started_at timestamp, input_rows bigint, "
    "rows_per_second double, batch_ms bigint"
)


def processed_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """``path, batch_id, modified_at, committed``: a row for each file the stream has taken, from the file source's log.

    The log has a file for each micro-batch, and every so often one that holds all before it; entries in both count once. A
    file is ``committed`` when its batch is in the commit log, that is when the sink has its rows.
    """
    root = checkpoint.rstrip("/")
    lines = spark.read.text(f"{root}/sources/{source}")
    entry = F.from_json("value", LOG_ENTRY)
    entries = lines.filter(F.col("value").startswith("{")).select(entry.alias("e")).select("e.*").distinct()
    done = spark.read.text(f"{root}/commits").select(F.regexp_extract("_metadata.file_name", r"^(\d+)", 1).alias("n"))
    done = done.filter("n <> ''").select(F.col("n").cast("bigint").alias("batchId")).distinct().withColumn("yes", F.lit(True))
    return entries.join(done, "batchId", "left").select(
        "path",
        F.col("batchId").alias("batch_id"),
        F.timestamp_millis("timestamp").alias("modified_at"),
        F.coalesce("yes", F.lit(False)).alias("committed"),
    )


class ProgressTable(StreamingQueryListener):
    """Appends a row to a table for every micro-batch of the session's queries, or of those with some names.

        listener = ProgressTable(spark, path).attach()
    """

    def __init__(self, spark: SparkSession, target: str, names: tuple[str, ...] = ()):
        super().__init__()
        self.spark, self.target, self.names, self.written = spark, target, names, 0

    def attach(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        if self.names and progress.get("name") not in self.names:
            return
        row = progress_row(progress)
        tables.append(self.spark.createDataFrame([row], PROGRESS).coalesce(1), self.target)
        self.written += 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def wait(self, rows: int, seconds: float) -> bool:
        """Whether that many rows have come in time: progress arrives a little after the batch."""
        until = time.monotonic() + seconds
        while self.written < rows and time.monotonic() < until:
            time.sleep(0.1)
        return self.written >= rows

    def read(self) -> DataFrame:
        return tables.read_table(self.spark, self.target)


def progress_row(progress: dict) -> tuple:
    """A row of ``PROGRESS`` from the JSON form of a query's progress."""
    started = datetime.datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00"))
    return (
        progress["id"],
        progress["runId"],
        progress.get("name"),
        progress["batchId"],
        started,
        progress.get("numInputRows", 0),
        float(progress.get("processedRowsPerSecond") or 0.0),
        progress.get("batchDuration"),
    )
