"""The tables of the pipeline as a graph of plain functions.

``build`` turns given inputs into any of the tables lazily; ``run_batch`` loads files and
writes every table, each stage reading what the one before has written.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.operators.audience import day_bitmaps, day_sketches, exact_distincts, sketched_distincts
from shopstream.operators.bronze import to_bronze
from shopstream.operators.silver import deduplicate, to_quarantine, to_silver
from shopstream.operators.state import (
    LOAD,
    SLOT,
    Kept,
    Partial,
    add_load,
    aggregates_path,
    bucket,
    compact_state,
    finish_load,
)
from shopstream.operators.upsert import new_rows
from shopstream.plans import customer, daily, funnel, product
from shopstream.plans.customer import customer_metrics
from shopstream.plans.daily import daily_sales_summary
from shopstream.plans.funnel import conversion_funnel
from shopstream.plans.product import product_performance
from shopstream.plans.quality_metrics import quality_metrics
from shopstream.schema import EVENT_COLUMNS, EVENT_KEY, MALFORMED
from shopstream.sources import catalog, tables
from shopstream.sources.csv_events import read_events_csv
from shopstream.sources.journal import Journal


@dataclass(frozen=True)
class Table:
    inputs: Sequence[str]
    make: Callable[..., DataFrame]
    comment: str
    partition_by: Sequence[str] = ()
    layer: str = "gold"
    statistics: Sequence[str] = ()


TABLES: dict[str, Table] = {
    "events_raw": Table(("source",), to_bronze, "events as delivered, with lineage", ("event_type",), "bronze", ("user_id",)),
    "events_cleaned": Table(("events_raw",), to_silver, "valid unique events", ("event_date",), "silver", ("user_id", "product_id")),
    "events_quarantine": Table(
        ("events_raw",), lambda raw: to_quarantine(raw, F.current_timestamp()), "rejected events", (), "bronze"
    ),
    "customer_metrics": Table(
        ("events_cleaned",), lambda s: customer_metrics(s, audit=True), "one row per user", (), "gold", ("user_id",)
    ),
    "product_performance": Table(
        ("events_cleaned",), lambda s: product_performance(s, audit=True), "one row per product", (), "gold", ("product_id",)
    ),
    "daily_sales_summary": Table(
        ("events_cleaned",), lambda s: daily_sales_summary(s, audit=True), "one row per day"
    ),
    "conversion_funnel": Table(
        ("events_cleaned",),
        lambda s: conversion_funnel(s, audit=True),
        "one row per day and top category",
    ),
    "data_quality_metrics": Table(
        ("events_raw", "events_cleaned"),
        lambda raw, clean: quality_metrics(raw, clean, F.current_timestamp()),
        "how many events survive cleaning",
    ),
}
GOLD = tuple(
    "customer_metrics product_performance daily_sales_summary conversion_funnel "
    "data_quality_metrics".split()
)


def build(
    given: Mapping[str, DataFrame], names: Sequence[str] = tuple(TABLES), graph=None
) -> dict[str, DataFrame]:
    """The named tables, each made from its inputs; ``given`` holds those already there."""
    graph = graph or TABLES
    done = dict(given)

    def make(name: str, path: tuple[str, ...] = ()) -> DataFrame:
        if name in path:
            raise ValueError(f"tables depend on each other: {' > '.join((*path, name))}")
        if name not in done:
            if name not in graph:
                raise KeyError(f"no table and no input named {name!r}")
            table = graph[name]
            done[name] = table.make(*[make(i, (*path, name)) for i in table.inputs])
        return done[name]

    return {name: make(name) for name in names}


def kept_tables(buckets: int = 32) -> dict[str, Kept]:
    """The aggregates below the gold tables that are kept by state: users and products in hash buckets, the others by day.

    The number of buckets belongs to the stored tables; it is part of their folder's name, so that another number starts anew.
    """
    day = F.col("event_date")
    return {
        f"customers-{buckets}": Kept(
            ("user_id",),
            bucket("user_id", buckets),
            {"activity": customer.ACTIVITY, "favourites": customer.FAVOURITES},
            customer.combine,
        ),
        f"products-{buckets}": Kept(
            ("product_id",),
            bucket("product_id", buckets),
            {"offers": product.OFFERS, "audience": product.AUDIENCE},
            product.combine,
        ),
        "days": Kept(("event_date",), day, {"grains": daily.PARTIAL}),
        "stages": Kept(("event_date", "category_l1"), day, {"grains": funnel.PARTIAL}),
    }


def run_batch(
    spark: SparkSession,
    csv_path: str,
    root: str,
    as_of: datetime.date | str | None = None,
    buckets: int = 32,
    compact_after: int = 16,
    keep_malformed: bool = False,
) -> dict[str, str]:
    """Load a folder of files and bring every table below ``root`` up to date; returns the path of each table.

    Loading the same files twice changes nothing: bronze takes new events only and silver
    keeps the first copy of an event id. A load's rows are staged in a journal first, so one that broke off, wherever, is completed
    before the next begins. Quarantine and silver are added to. Gold tables are kept by state: the load's events are
    reduced to partial rows, and only the users, products and days among them are merged and finished again. After every
    ``compact_after`` loads the state of all loads so far is merged into one.

    Rewritten are: days of the funnel that have new events; buckets of the customer table that have, or all if the day
    recency counts from has moved; the product table, whose ranks compare all products, and the daily one, whose
    frames run over all days, from their aggregates. One load runs at a time. ``keep_malformed``, the same for all
    loads of a lake, brings unreadable records into quarantine with their text.
    """
    lake = Lake(spark, root, as_of, kept_tables(buckets))
    for load in lake.journal.open():
        lake.complete(load)
    load = lake.journal.begin()
    lake.journal.stage(load, "delivered", to_bronze(read_events_csv(spark, csv_path, keep_malformed=keep_malformed)))
    lake.complete(load)
    if len(lake.journal.closed()) % compact_after == 0:
        for name, kept in lake.kept.items():
            if tables.exists(spark, aggregates_path(lake.state(name))):
                compact_state(spark, kept, lake.state(name))
        if tables.exists(spark, f"{lake.state('audience')}/bitmaps"):
            compact_state(spark, lake.audience, lake.state("audience"))
    return lake.at


def period_audience(spark: SparkSession, root: str, period: Column, exact: bool = True) -> DataFrame:
    """Distinct users, buyers, products and sold products of each period, say ``week_of()``, from the days a lake has stored.

    ``exact=False`` reads the sketches, far smaller, which also count sessions.
    """
    state = f"{root.rstrip('/')}/_state/audience"
    if exact:
        return exact_distincts(tables.read_table(spark, f"{state}/bitmaps"), period)
    return sketched_distincts(tables.read_table(spark, f"{state}/sketches"), period)


def register_tables(spark: SparkSession, at: Mapping[str, str], database: str) -> list[str]:
    """Catalog names, comments, properties and statistics for the tables of a load that exist; returns the names."""
    meanings = {name: meaning for name, _, meaning in EVENT_COLUMNS}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    made = []
    for name, table in TABLES.items():
        if tables.exists(spark, at[name]):
            facts = {"layer": table.layer, "inputs": ",".join(table.inputs)}
            catalog.register(spark, f"{database}.{name}", at[name], table.comment, facts, meanings, table.statistics)
            made.append(f"{database}.{name}")
    return made


def at_once(steps: Mapping[str, Callable]) -> dict:
    """Results of independent steps, each a few small jobs: together they leave fewer executors idle."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        waiting = {name: pool.submit(step) for name, step in steps.items()}
        return {name: future.result() for name, future in waiting.items()}


class Lake:
    """The tables below a folder and the steps of a load. Each step may be repeated."""

    def __init__(self, spark: SparkSession, root: str, as_of: datetime.date | str | None, kept: Mapping[str, Kept]):
        self.spark, self.root, self.as_of, self.kept = spark, root.rstrip("/"), as_of, dict(kept)
        self.at = {name: f"{self.root}/{name}" for name in TABLES}
        self.journal = Journal(spark, self.root)
        whole = Partial(day_bitmaps, day_bitmaps, {"bits": "bitmap_or_agg"})
        sketched = Partial(day_sketches, day_sketches, {"sketch": "hll_union_agg"})
        # Members of each day, merged by whoever asks for a period.
        self.audience = Kept(("event_date",), F.col("event_date"), {"bitmaps": whole, "sketches": sketched})

    def state(self, name: str) -> str:
        return f"{self.root}/_state/{name}"

    def read(self, name: str) -> DataFrame:
        return tables.read_table(self.spark, self.at[name])

    def complete(self, load: str) -> None:
        delivered = self.journal.staged(load, "delivered")
        if delivered is not None:  # else it broke off before it changed anything
            # Records that could not be read have no key but their text.
            more = (MALFORMED,) if MALFORMED in delivered.columns else ()
            raw = self._add(load, "events_raw", delivered, (*EVENT_KEY, *more))
            # Unique by id before the derived columns exist; the range of times needs no unique rows.
            clean, valid = to_silver(raw, by_id=True), to_silver(raw, dedup=False)
            events = self._add(load, "events_cleaned", clean, ("event_id",), unique=True, times=valid)
            self._quarantine(load, raw)
            if tables.exists(self.spark, self.at["events_cleaned"]):
                self._gold(self._kept(load, events))
        self.journal.close(load)

    def _add(
        self, load: str, name: str, rows: DataFrame, keys: Sequence[str], unique: bool = False, times: DataFrame | None = None
    ) -> DataFrame:
        """Append the rows whose key is new, first staged; returns them. ``unique`` and ``times`` are as in ``new_rows``."""
        there = tables.exists(self.spark, self.at[name])
        before = self.journal.staged(load, name)
        if before is None:
            if there:
                fresh = new_rows(rows, self.at[name], keys, unique=unique, times=times)
            else:
                fresh = rows if unique else deduplicate(rows, keys)
            fresh = self.journal.stage(load, name, fresh)
            left = fresh
        else:  # the load broke off, perhaps while it appended
            fresh = before
            left = new_rows(fresh, self.at[name], keys, unique=True) if there else fresh
        if not left.isEmpty():
            tables.append(left, self.at[name], TABLES[name].partition_by)
        return fresh

    def _quarantine(self, load: str, raw: DataFrame) -> None:
        rejected = to_quarantine(raw, F.current_timestamp()).withColumn(LOAD, F.lit(load))
        if not rejected.isEmpty():
            tables.replace_partitions(rejected, self.at["events_quarantine"], [LOAD])

    def _kept(self, load: str, events: DataFrame) -> dict[str, list]:
        """Slots touched in each kept table. One without any state is made from all events."""

        def keep(name: str, kept: Kept) -> list:
            ready = f"{self.root}/_state/_ready-{name}"
            known = tables.exists(self.spark, ready)
            some = events if known else self.read("events_cleaned")
            slots = add_load(kept, some, self.state(name), load)
            done = finish_load(kept, some, self.state(name), slots, load) if name in self.kept else slots
            if not known:
                tables.touch(self.spark, ready)
            return done

        return at_once({n.split("-")[0]: partial(keep, n, k) for n, k in {**self.kept, "audience": self.audience}.items()})

    def _aggregates(self, name: str) -> DataFrame:
        full = next(n for n in self.kept if n.split("-")[0] == name)
        return tables.read_table(self.spark, aggregates_path(self.state(full)))

    def _gold(self, touched: Mapping[str, list]) -> None:
        now = F.current_timestamp().alias("processed_timestamp")
        days = self._aggregates("days").drop(SLOT)
        last = self.as_of or days.agg(F.max("event_date")).first()[0]

        def products() -> None:
            ranked = product.rank_products(product.derive(self._aggregates("products").drop(SLOT)))
            tables.write_full(ranked.select("*", now), self.at["product_performance"])

        def summary() -> None:
            tables.write_full(daily.derive(days).select("*", now).orderBy("event_date"), self.at["daily_sales_summary"])

        def stages() -> None:
            some = self._aggregates("stages").filter(tables.in_partitions(SLOT, touched["stages"])).drop(SLOT)
            tables.replace_partitions(funnel.derive(some).select("*", now), self.at["conversion_funnel"], ["event_date"])

        def quality() -> None:
            counts = quality_metrics(self.read("events_raw"), self.read("events_cleaned"), F.current_timestamp())
            tables.write_full(counts, self.at["data_quality_metrics"])

        steps = {"products": products, "days": summary, "stages": stages}
        at_once(
            {
                "customers": lambda: self._customers(touched["customers"], str(last), now),
                "quality": quality,
                **{name: step for name, step in steps.items() if touched[name]},
            }
        )

    def _customers(self, touched: Sequence[int], today: str, now: Column) -> None:
        """Recency counts from one day for all customers: while that day stands, only touched buckets change."""
        mark, target = f"{self.root}/_state/recency", self.at["customer_metrics"]
        rows = self._aggregates("customers")
        made = customer.derive(rows, F.to_date(F.lit(today))).select("*", now)
        if tables.children(self.spark, mark) == [today] and tables.exists(self.spark, target):
            if touched:
                tables.replace_partitions(made.filter(tables.in_partitions(SLOT, touched)), target, [SLOT])
            return
        tables.drop_path(self.spark, mark)
        tables.write_full(made, target, [SLOT])
        tables.touch(self.spark, f"{mark}/{today}")
