"""Upkeep of Parquet tables: compaction, clustering, statistics, retention."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.session import scratch_path
from shopstream.sources import tables

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def compact(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str] | None = None,
    file_bytes: int = 256 << 20,
    only: Sequence[object] | None = None,
) -> tuple[int, int]:
    """Merge small files; returns the number of files before and after.

    Files are sized by adaptive rebalancing to about ``file_bytes``, so large partitions get
    several files and hot ones are not written by a single task. On a large table name
    the values of the first partition column to rewrite in ``only``, say the days
    loaded since the last time (None for the partition without one); other partitions are
    neither read nor written. The table keeps its partition columns, found from its folders;
    ``partition_by`` may name them, and others are refused.
    """
    there = tables.partition_columns(spark, path)
    if partition_by is not None and list(partition_by) != there:
        raise ValueError(f"{path} is partitioned by {there}, not by {list(partition_by)}")
    if only is not None and not there:
        raise ValueError(f"{path} has no partitions to choose from")
    partition_by = there
    folders = None if only is None else [tables.partition_folder(spark, there[0], v) for v in only]
    before = tables.data_files(spark, path, folders)
    saved = spark.conf.get(ADVISORY)
    spark.conf.set(ADVISORY, str(file_bytes))
    try:
        df = tables.read_table(spark, path)
        if only is not None:
            tables.replace_from_itself(df.filter(tables.in_partitions(partition_by[0], only)), path, partition_by)
        else:
            df = df if partition_by else df.hint("rebalance")
            tables.write_full(df, path, partition_by)
    finally:
        spark.conf.set(ADVISORY, saved)
    return before, tables.data_files(spark, path, folders)


def cluster(df: DataFrame, cols: Sequence[str], curve: str = "linear", files: int | None = None) -> DataFrame:
    """Order rows so that files cover narrow ranges of ``cols`` and readers can skip them.

    ``linear`` sorts by the columns in turn, best for filters on the first. ``morton``
    interleaves the bits of whole-number columns, so filters on any of them skip files.
    """
    if curve == "linear":
        keys = [F.col(c) for c in cols]
        ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
        return ranged.sortWithinPartitions(*keys)
    keyed = df.withColumn("_curve", morton_key(df, cols))
    ranged = keyed.repartitionByRange(files, "_curve") if files else keyed.repartitionByRange("_curve")
    return ranged.sortWithinPartitions("_curve").drop("_curve")


def morton_key(df: DataFrame, cols: Sequence[str], bits: int = 16) -> Column:
    """Interleaved bits of the columns, each scaled to ``bits`` bits over its range.

    Reads the ranges (one row) up front, as the scale must be the same for all tasks.
    """
    bits = min(bits, 62 // len(cols))
    bounds = df.agg(*[f(c).cast("double") for c in cols for f in (F.min, F.max)]).first()
    top = (1 << bits) - 1
    scaled = []
    for i, c in enumerate(cols):
        low, high = bounds[2 * i], bounds[2 * i + 1]
        span = (high - low) if low is not None and high > low else 1.0
        part = F.floor((F.col(c).cast("double") - F.lit(low or 0.0)) / span * top)
        scaled.append(F.coalesce(part.cast("bigint"), F.lit(0).cast("bigint")))
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, part in enumerate(scaled):
            one = F.shiftright(part, bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(cols) + i))
    return key


def analyze(spark: SparkSession, table: str, columns: Sequence[str] = ()) -> None:
    """Collect table, and if named column, statistics for the optimizer."""
    suffix = f" FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{suffix}")


def apply_retention(
    spark: SparkSession,
    path: str,
    keep_days: int,
    as_of: datetime.date,
    partition_column: str = "event_date",
) -> list[str]:
    """Delete the date partitions older than ``keep_days``; returns the dates removed.

    Works on folders alone: kept data is neither read nor rewritten.
    """
    limit = (as_of - datetime.timedelta(days=keep_days)).isoformat()
    # Dates in ISO form sort as text; the folder of NULL dates is not one of them.
    dated = [v for v in tables.partition_values(spark, path, partition_column) if v[:1].isdigit()]
    expired = [v for v in dated if v < limit]
    for value in expired:
        tables.drop_partition(spark, path, f"{partition_column}={value}")
    spark.catalog.refreshByPath(path)
    return expired
