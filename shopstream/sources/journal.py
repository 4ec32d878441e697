"""A journal of loads: what each one brings is staged before any table changes, and it is closed after the last.

A load that broke off stays open, and its staged rows say exactly what is left to do. Every step
must be one that can be repeated: an append that looks for keys already there, or a replacement.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession

from shopstream.sources import tables

CLOSED = "_CLOSED"


class Journal:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/_loads"

    def begin(self) -> str:
        """A new load's name; names sort by the time they were given."""
        stamp = datetime.datetime.now(datetime.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        return f"load-{stamp}-{uuid.uuid4().hex[:6]}"

    def _path(self, load: str, name: str) -> str:
        return f"{self.root}/{load}/{name}"

    def staged(self, load: str, name: str) -> DataFrame | None:
        """Rows staged before; a write that broke off counts as none."""
        path = self._path(load, name)
        if not tables.exists(self.spark, f"{path}/_SUCCESS"):
            return None
        return self.spark.read.parquet(path)

    def stage(self, load: str, name: str, rows: DataFrame) -> DataFrame:
        path = self._path(load, name)
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _loads(self) -> list[tuple[str, bool]]:
        names = tables.children(self.spark, self.root)
        return [(n, tables.exists(self.spark, self._path(n, CLOSED))) for n in sorted(names)]

    def open(self) -> list[str]:
        """Loads that have staged rows and were not closed, oldest first."""
        return [n for n, closed in self._loads() if not closed]

    def closed(self) -> list[str]:
        return [n for n, closed in self._loads() if closed]

    def close(self, load: str) -> None:
        """Mark a load as done, then let go of what it staged."""
        tables.touch(self.spark, self._path(load, CLOSED))
        for name in tables.children(self.spark, f"{self.root}/{load}"):
            if name != CLOSED:
                tables.drop_path(self.spark, self._path(load, name))
