"""Distinct users, buyers, products and sold products of any period, from one small table of days.

A distinct count of a week is not the sum of its days. What can be merged is kept for each day: for whole-number ids an exact bitmap, cut into
blocks of ids, and for any kind of value a sketch of fixed size. Weeks, months or any range of days are then
answered from stored days, without the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ids per block of a bitmap, as ``bitmap_construct_agg`` has it; its size in bytes is an eighth.
BLOCK_IDS = 32_768
SKETCH_LOG2 = 12
# Relative standard error of a sketch with 2^SKETCH_LOG2 registers.
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LOG2 / 2)

# What is counted: column, and whether purchases alone count.
COUNTED = {
    "users": ("user_id", False),
    "buyers": ("user_id", True),
    "products": ("product_id", False),
    "products_sold": ("product_id", True),
    "sessions": ("user_session", False),
}
WHOLE = ("users", "buyers", "products", "products_sold")


def _members(silver: DataFrame, names) -> DataFrame:
    """``event_date, counted, member``: what each event counts for, once a day and member."""
    kinds = dict(silver.dtypes)
    bought = F.col("event_type") == "purchase"
    entries = []
    for name in names:
        column, only_bought = COUNTED[name]
        member = F.col(column) if kinds[column] != "string" else F.xxhash64(F.col(column))
        known = F.when(F.col(column).isNotNull(), member.cast("bigint"))
        entries.append(F.struct(F.lit(name).alias("counted"), (F.when(bought, known) if only_bought else known).alias("member")))
    return silver.select("event_date", F.inline(F.array(*entries))).filter("member IS NOT NULL")


def day_bitmaps(silver: DataFrame) -> DataFrame:
    """``event_date, counted, block, bits``: an exact bitmap of each day's ids, ``BLOCK_IDS`` consecutive ones a row.

    A hot day is spread: blocks are combined in the task and shuffled by day and block.
    """
    return (
        _members(silver, WHOLE)
        .groupBy("event_date", "counted", F.expr("bitmap_bucket_number(member)").alias("block"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(member))").alias("bits"))
    )


def day_sketches(silver: DataFrame) -> DataFrame:
    """``event_date, counted, sketch``: one sketch of fixed size for each day and kind, text values too."""
    return _members(silver, COUNTED).groupBy("event_date", "counted").agg(
        F.hll_sketch_agg("member", F.lit(SKETCH_LOG2)).alias("sketch")
    )


def merge_bitmaps(*days: DataFrame) -> DataFrame:
    """Stored days and those of a further load as one: the same day may stand in several."""
    return _union(days).groupBy("event_date", "counted", "block").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))


def merge_sketches(*days: DataFrame) -> DataFrame:
    return _union(days).groupBy("event_date", "counted").agg(F.hll_union_agg("sketch").alias("sketch"))


def _union(days) -> DataFrame:
    out = days[0]
    for more in days[1:]:
        out = out.unionByName(more)
    return out


def week_of(day: str = "event_date") -> Column:
    """Monday of the day's week."""
    return F.date_trunc("week", F.col(day)).cast("date")


def month_of(day: str = "event_date") -> Column:
    return F.date_trunc("month", F.col(day)).cast("date")


def exact_distincts(bitmaps: DataFrame, period: Column) -> DataFrame:
    """``period`` and one column for each of ``WHOLE``, exact, from stored days."""
    merged = bitmaps.groupBy(period.alias("period"), "counted", "block").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
    counts = merged.groupBy("period").agg(
        *[F.sum(F.when(F.col("counted") == n, F.expr("bitmap_count(bits)"))).alias(n) for n in WHOLE]
    )
    return counts.fillna(0, list(WHOLE))


def sketched_distincts(sketches: DataFrame, period: Column) -> DataFrame:
    """The same for all of ``COUNTED``, within ``SKETCH_ERROR`` as a relative standard error."""
    merged = sketches.groupBy(period.alias("period"), "counted").agg(F.hll_union_agg("sketch").alias("sketch"))
    counts = merged.groupBy("period").agg(
        *[F.max(F.when(F.col("counted") == n, F.hll_sketch_estimate("sketch"))).alias(n) for n in COUNTED]
    )
    return counts.fillna(0, list(COUNTED))
