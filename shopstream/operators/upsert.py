"""Incremental loads without MERGE: insert-only and update-or-insert.

The DataFrame forms are lazy and describe rows; the table forms apply them to
Parquet tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.operators.silver import FIRST_SEEN, deduplicate
from shopstream.schema import EVENT_KEY
from shopstream.session import scratch_path
from shopstream.sources import tables


def _without_keys_of(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key, NULLs included, does not occur in ``right``."""
    other = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return left.join(other, same, "left_anti")


def insert_new(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = EVENT_KEY,
    order: Sequence[str] = FIRST_SEEN,
) -> DataFrame:
    """The source rows to append: first of each key, key not in the target yet."""
    return _without_keys_of(deduplicate(source, keys, order), target, keys)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = ("event_id",),
    order: Sequence[str] = FIRST_SEEN,
) -> DataFrame:
    """New table content: source rows replace target rows of the same key, others stay.

    Columns known to one side only are kept and filled with NULL.
    """
    fresh = deduplicate(source, keys, order)
    kept = _without_keys_of(target, fresh, keys)
    return kept.unionByName(fresh, allowMissingColumns=True)


def insert_new_table(
    source: DataFrame,
    target: str,
    keys: Sequence[str] = EVENT_KEY,
    partition_by: Sequence[str] = ("event_type",),
    order: Sequence[str] = FIRST_SEEN,
) -> None:
    """Append the new rows to a table, creating it on the first load."""
    spark = source.sparkSession
    if not tables.exists(spark, target):
        tables.write_full(deduplicate(source, keys, order), target, partition_by)
        return
    # Written first: the batch is read three times and must be the same each time.
    path = scratch_path(spark, "batch")
    source.write.parquet(path)
    batch = spark.read.schema(source.schema).parquet(path)
    tables.append(new_rows(batch, target, keys, order), target, partition_by)
    tables.drop_path(spark, path)


def new_rows(
    batch: DataFrame,
    target: str,
    keys: Sequence[str] = EVENT_KEY,
    order: Sequence[str] = FIRST_SEEN,
    unique: bool = False,
    times: DataFrame | None = None,
) -> DataFrame:
    """The rows of a batch to append to a table.

    Only target rows inside the batch's event-time range can match, so the key lookup
    reads no others when the time is part of the key. The batch is read twice, or ``times`` in the place of the first: rows
    with the same range of times that cost less. ``unique`` says that no key occurs twice in the batch.
    """
    known = tables.read_table(batch.sparkSession, target)
    if {"event_time", "event_id"} & set(keys):  # the id is made from the time, among others
        low, high = (batch if times is None else times).agg(F.min("event_time"), F.max("event_time")).first()
        undated = F.col("event_time").isNull()
        known = known.filter(undated if low is None else undated | F.col("event_time").between(low, high))
    return _without_keys_of(batch, known, keys) if unique else insert_new(known, batch, keys, order)


def upsert_table(
    source: DataFrame,
    target: str,
    keys: Sequence[str] = ("event_id",),
    partition_column: str = "event_date",
    order: Sequence[str] = FIRST_SEEN,
    moves: bool = False,
    keep: str = "source",
) -> None:
    """Update or insert into a partitioned table, rewriting touched partitions only.

    For a key on both sides ``keep="source"`` takes the new row, ``keep="first"`` the one
    lower in ``order``, so that late copies of an event change nothing.

    Touched are the partitions of the batch, that of NULL included. With the default key a row cannot change its
    partition, as the id covers the event time; for keys that allow it set ``moves`` and
    the partitions now holding those rows are looked up and rewritten too.
    The new content is written once and complete before any old file goes, so
    tasks lost on the way are re-run from data that is still there.
    """
    spark = source.sparkSession
    if not tables.exists(spark, target):
        tables.write_full(deduplicate(source, keys, order), target, [partition_column])
        return
    batch_path = scratch_path(spark, "batch")
    source.write.parquet(batch_path)
    batch = spark.read.schema(source.schema).parquet(batch_path)
    current = tables.read_table(spark, target)
    touched = batch.select(partition_column)
    if moves:
        ids = batch.select(*keys).distinct()
        touched = touched.union(current.join(ids, list(keys), "left_semi").select(partition_column))
    # One value per partition folder: the column must be one with few values, such as a date.
    values = [r[0] for r in touched.distinct().collect()]
    before = current.filter(tables.in_partitions(partition_column, values))
    if keep == "first":
        both = before.unionByName(batch, allowMissingColumns=True)
        content = deduplicate(both, keys, order)
    else:
        content = upsert(before, batch, keys, order)
    filled = tables.swap_partitions(content, target, partition_column)
    if moves:
        for folder in {tables.partition_folder(spark, partition_column, v) for v in values} - set(filled):
            tables.drop_partition(spark, target, folder)
        spark.catalog.refreshByPath(target)
    tables.drop_path(spark, batch_path)
