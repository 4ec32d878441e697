"""Aggregates kept as state: partial rows of each load, merged and finished for touched keys only.

A ``Partial`` splits an aggregation in two: ``make`` turns events into partial rows, ``finish`` turns merged partial rows into one
row per key. Partial rows of different loads that agree in all but their measures can be added up, so a table of them answers
for all events loaded so far, distinct counts and most frequent values included.

Rows are stored by slot (a day, or a hash bucket of the key) and by load. Writing a load again replaces its own rows and
no others, so a load that broke off is simply repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.session import scratch_path
from shopstream.sources import tables

# Measures of grouped rows that add up.
GRAIN_SUMS = dict.fromkeys(("n", "views", "carts", "removes", "purchases"), "sum")
SLOT, LOAD = "slot", "load"
MERGED = "merged"


@dataclass(frozen=True)
class Partial:
    """``merged`` names the measures of the partial rows and how two of them become one: sum, min or max."""

    make: Callable[[DataFrame], DataFrame]
    finish: Callable[[DataFrame], DataFrame]
    merged: Mapping[str, str]

    def merge(self, rows: DataFrame) -> DataFrame:
        by = [c for c in rows.columns if c not in self.merged]
        return rows.groupBy(*by).agg(*[getattr(F, how)(c).alias(c) for c, how in self.merged.items()])

    def apply(self, events: DataFrame) -> DataFrame:
        return self.finish(self.make(events))


@dataclass(frozen=True)
class Kept:
    """A table of aggregates, one row per ``keys``, kept up to date from the partial rows of each load.

    ``slot`` is a function of the keys. ``combine`` joins the finished parts, in the order of ``partials``.
    """

    keys: Sequence[str]
    slot: Column
    partials: Mapping[str, Partial]
    combine: Callable[..., DataFrame] = field(default=lambda only: only)

    def same(self, other: str = "_k_") -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(other + k)) for k in self.keys])


def bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def aggregates_path(root: str) -> str:
    return f"{root}/aggregates"


def add_load(kept: Kept, events: DataFrame, root: str, load: str) -> list:
    """Store the partial rows of a load's events; returns the slots touched."""
    touched = events.select(kept.slot.alias(SLOT)).distinct()
    for name, partial in kept.partials.items():
        rows = partial.make(events).withColumns({SLOT: kept.slot, LOAD: F.lit(load)})
        tables.replace_partitions(rows, f"{root}/{name}", [SLOT, LOAD])
    # Days, or buckets of a fixed number.
    return sorted((r[0] for r in touched.collect()), key=lambda v: (v is None, v))


def stored_loads(spark: SparkSession, path: str) -> set[str]:
    """Names of the loads whose rows a table of partial rows holds, from its folders alone."""
    slots = [n for n in tables.children(spark, path) if "=" in n]
    names = (n for s in slots for n in tables.children(spark, f"{path}/{s}"))
    return {n.split("=", 1)[1] for n in names if n.startswith(f"{LOAD}=")}


def finish_load(
    kept: Kept, events: DataFrame, root: str, touched: Sequence[object], load: str | None = None
) -> list:
    """Bring the aggregates of the keys in ``events`` up to date; returns the slots rewritten.

    Only state rows of those keys are merged; other keys of a touched slot are copied, other slots not read. The keys are
    written first, once for all who look them up: Spark then knows their size. Where ``load``, that of the events, is
    the only one stored, its rows are merged as they stand.
    """
    spark, path = events.sparkSession, aggregates_path(root)
    if not touched:
        return []
    alone = {n: stored_loads(spark, f"{root}/{n}") == {load} for n in kept.partials}
    there, keys, at = tables.exists(spark, path), None, scratch_path(spark, "keys")
    if there or not all(alone.values()):
        found = events.select(*[F.col(k).alias(f"_k_{k}") for k in kept.keys]).distinct()
        found.write.parquet(at)
        keys = spark.read.schema(found.schema).parquet(at)
    parts = []
    for name, partial in kept.partials.items():
        rows = tables.read_table(spark, f"{root}/{name}").filter(tables.in_partitions(SLOT, touched)).drop(SLOT, LOAD)
        if not alone[name]:
            rows = partial.merge(rows.join(keys, kept.same(), "left_semi"))
        parts.append(partial.finish(rows))
    made = kept.combine(*parts).withColumn(SLOT, kept.slot)
    if there:
        old = tables.read_table(spark, path).filter(tables.in_partitions(SLOT, touched))
        made = made.unionByName(old.join(keys, kept.same(), "left_anti"))
    tables.swap_partitions(made, path, SLOT)
    tables.drop_path(spark, at)
    return list(touched)


def aggregates(spark: SparkSession, root: str) -> DataFrame:
    """All aggregates, without the slot."""
    return tables.read_table(spark, aggregates_path(root)).drop(SLOT)


def compact_state(spark: SparkSession, kept: Kept, root: str) -> None:
    """Merge the rows of all loads, so that state grows with its keys and not with the number of loads.

    Each table is replaced as a whole. To be run while no load is open.
    """
    for name, partial in kept.partials.items():
        path = f"{root}/{name}"
        rows = partial.merge(tables.read_table(spark, path).drop(LOAD))
        tables.write_full(rows.withColumn(LOAD, F.lit(MERGED)), path, [SLOT, LOAD])
