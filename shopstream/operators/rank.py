"""Ranks over a whole table without bringing it into one task.

Values are whole numbers. Equal values first collapse to one row with a count, so a
value shared by most rows costs nothing. Distinct values fall into buckets of
``2**FINE_BITS`` consecutive numbers, and these into buckets of ``2**COARSE_BITS``. A window
inside a fine bucket, or over the fine buckets of a coarse one, never sees more than
a few thousand rows; only totals of coarse buckets are summed up in value order. For
non-negative values with total T there are at most about ``sqrt(2 * T / 2**COARSE_BITS)``
coarse buckets (the k-th holds a value of at least k bucket widths): with revenue in
ten-thousandths, 350,000 rows for a total of 100 trillion.

Buckets depend on the value alone, so the plan is lazy and safe to recompute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FINE_BITS = 12
COARSE_BITS = 24


def rank_table(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    rank: str,
    percent: str | None = None,
    count: str | None = None,
) -> DataFrame:
    """One row per distinct (by, value) with its ranks within ``by``.

    ``rank`` is the dense rank from the highest value down; ``percent`` is the share
    of other rows with a lower value, as ``percent_rank`` gives going up. ``count`` names a
    column that tells how many rows a row of ``df`` stands for.
    """
    counts = (
        df.groupBy(*by, value)
        .agg((F.sum(count) if count else F.count("*")).alias("_rows"))
        .withColumns({"_fine": F.shiftright(value, FINE_BITS), "_coarse": F.shiftright(value, COARSE_BITS)})
    )
    fine = counts.groupBy(*by, "_coarse", "_fine").agg(
        F.count("*").alias("_values"), F.sum("_rows").alias("_rows")
    )
    coarse = fine.groupBy(*by, "_coarse").agg(F.sum("_values").alias("_values"), F.sum("_rows").alias("_rows"))

    def before(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    inside = Window.partitionBy(*by, "_fine").orderBy(value)
    among = Window.partitionBy(*by, "_coarse").orderBy("_fine")
    along, whole = Window.partitionBy(*by).orderBy("_coarse"), Window.partitionBy(*by)
    local = counts.select(
        *by, value, "_fine", F.row_number().over(inside).alias("_nth"), before("_rows", inside).alias("_below")
    )
    tops = coarse.select(
        *[F.col(c).alias(f"_t_{c}") for c in [*by, "_coarse"]],
        before("_values", along).alias("_values_1"),
        before("_rows", along).alias("_rows_1"),
        F.sum("_values").over(whole).alias("_all_values"),
        F.sum("_rows").over(whole).alias("_all_rows"),
    )
    middles = fine.select(
        *[F.col(c).alias(f"_m_{c}") for c in [*by, "_fine"]],
        F.col("_coarse"),
        before("_values", among).alias("_values_2"),
        before("_rows", among).alias("_rows_2"),
    )

    def same(left: str, right: str, last: str) -> Column:
        out = F.col("_coarse" if left else last) == F.col(f"{right}{last}")
        for c in by:
            out = out & F.col(f"{left}{c}").eqNullSafe(F.col(f"{right}{c}"))
        return out

    offsets = middles.join(tops, same("_m_", "_t_", "_coarse")).select(
        *[f"_m_{c}" for c in [*by, "_fine"]],
        (F.col("_values_1") + F.col("_values_2")).alias("_values_before"),
        (F.col("_rows_1") + F.col("_rows_2")).alias("_rows_before"),
        "_all_values",
        "_all_rows",
    )
    lower = (F.col("_rows_before") + F.col("_below")).cast("double")
    share = F.when(F.col("_all_rows") > 1, lower / (F.col("_all_rows") - 1)).otherwise(F.lit(0.0))
    position = F.col("_all_values") - F.col("_values_before") - F.col("_nth") + 1
    extra = [share.alias(percent)] if percent else []
    joined = local.join(offsets, same("", "_m_", "_fine"))
    return joined.select(*by, value, position.cast("int").alias(rank), *extra)


def attach_rank(df: DataFrame, ranks: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Join a rank table back; a value shared by many rows is left to adaptive skew handling."""
    keys = [*by, value]
    renamed = ranks.withColumnsRenamed({c: f"_r_{c}" for c in keys})
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return df.join(renamed, same).drop(*[f"_r_{c}" for c in keys])
