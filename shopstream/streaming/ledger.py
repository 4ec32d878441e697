"""New columns in a running stream: a ledger of schemas in the checkpoint.

The file source reads columns by place, so the ledger holds the columns in file order. Before a query (re)starts, the headers of
files that have come since are compared with it. A header that goes on where the ledger ends widens it; one that stops earlier is
an older form, whose last columns are then NULL; anything else is an error that names the file, before a row is read wrongly.
"""

from __future__ import annotations

import csv
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shopstream.schema import RAW_SCHEMA
from shopstream.sources import tables
from shopstream.streaming.events import read_event_stream


class SchemaLedger:
    """Versions of a stream's schema, each a file of the checkpoint folder."""

    def __init__(self, spark: SparkSession, checkpoint: str, first: T.StructType = RAW_SCHEMA):
        self.spark, self.folder, self.first = spark, f"{checkpoint.rstrip('/')}/schemas", first

    def versions(self) -> list[T.StructType]:
        return [v for v, _ in self._entries()]

    def _entries(self) -> list[tuple[T.StructType, int]]:
        found = []
        for name in sorted(tables.children(self.spark, self.folder)):
            entry = json.loads(tables.read_text(self.spark, f"{self.folder}/{name}"))
            found.append((T.StructType.fromJson(entry["schema"]), entry["seen"]))
        return found

    def current(self) -> T.StructType:
        entries = self._entries()
        return entries[-1][0] if entries else self.first

    def refresh(self, path: str) -> T.StructType:
        """The schema after a look at the headers of files modified since the last one; a wider one, or a later look, is a new version.

        Files of the same moment are looked at again. One line of each new file is read, on the driver.
        """
        entries = self._entries()
        schema, seen = entries[-1] if entries else (self.first, -1)
        known, latest = schema, seen
        for file, modified in sorted(tables.files(self.spark, path, ".csv"), key=lambda f: (f[1], f[0])):
            if modified >= seen:
                schema = widened(schema, header(tables.first_line(self.spark, file)), file)
                latest = max(latest, modified)
        if schema != known or latest > seen:
            entry = {"schema": schema.jsonValue(), "seen": latest}
            tables.write_text(self.spark, f"{self.folder}/{len(entries):06d}.json", json.dumps(entry))
        return schema

    def read_stream(self, path: str, max_files: int | None = None, **options: str) -> DataFrame:
        """``read_event_stream`` with the ledger's schema as of now; restart the query for columns that come later."""
        return read_event_stream(self.spark, path, self.refresh(path), max_files, **options)


def header(line: str) -> list[str]:
    return next(csv.reader([line]), [])


def widened(schema: T.StructType, names: list[str], file: str = "") -> T.StructType:
    """The schema, with text columns added for names beyond its last."""
    known = schema.names
    if known[: len(names)] != names[: len(known)]:
        raise ValueError(f"columns of {file} are {names}, not a shorter or longer form of {known}")
    if len(set(names)) != len(names):
        raise ValueError(f"{file} names a column twice: {names}")
    for name in names[len(known) :]:
        schema = T.StructType([*schema.fields, T.StructField(name, T.StringType())])
    return schema
