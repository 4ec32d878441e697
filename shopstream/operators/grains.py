"""Exact distinct counts of many kinds from one pass.

A gold row needs distinct sessions, users, products ... each split by what
happened to them (seen, carted, bought). Writing one ``count_distinct`` per
figure makes Spark copy every input row once for each. Here each *entity* costs one copy:
rows are grouped to (group, entity value) with per-type counts, and every figure of
that entity is then a count of grouped rows.

The first shuffle is keyed by group and entity value together, after a map-side
combine, so a group holding a large share of the table is spread over all tasks;
the second one sees at most one row per group and task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.functions.numerics import MONEY_UNITS, case_when

ENTITY = "_entity"

# Per-type counters and the event type each one counts.
TYPE_COUNTERS = {
    "views": "view",
    "carts": "cart",
    "removes": "remove_from_cart",
    "purchases": "purchase",
}


def typed(df: DataFrame, keep: Sequence[str], revenue: bool = False) -> DataFrame:
    """Project to the needed columns with the event type turned into 0/1 counters.

    With ``revenue`` the purchase amount comes along as whole money units, NULL for
    other types.
    """
    flags = [f"CAST(event_type = '{t}' AS BIGINT) AS {c}" for c, t in TYPE_COUNTERS.items()]
    extra = []
    if revenue:
        bought = "CASE WHEN event_type = 'purchase' THEN {} END"
        extra = [
            bought.format(f"CAST(round(price * {MONEY_UNITS}) AS BIGINT)") + " AS paid_units",
            bought.format("price") + " AS paid",
        ]
    return df.selectExpr(*keep, *flags, *extra)


def type_sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in TYPE_COUNTERS]


def entity_grains(
    df: DataFrame, by: Sequence[str], entities: Mapping[str, str], measures: Sequence[Column]
) -> DataFrame:
    """One row per (group, entity kind, entity value) with ``n`` and the measures.

    ``entities`` maps a kind to the column holding its values. The kind is returned in
    the ``_entity`` column; the columns of other kinds are NULL in that row.
    """
    columns = [*by, *entities.values()]
    top = len(columns) - 1
    ids = {
        kind: sum(1 << (top - i) for i, c in enumerate(columns) if c not in (*by, column))
        for kind, column in entities.items()
    }
    sets = [[*by, column] for column in entities.values()]
    kind_of = case_when((f"_gid = {gid}", kind) for kind, gid in ids.items())
    return (
        df.groupingSets(sets, *columns)
        .agg(F.grouping_id().cast("bigint").alias("_gid"), F.count("*").alias("n"), *measures)
        .withColumn(ENTITY, kind_of)
        .drop("_gid")
    )


def distinct_if(kind: str, column: str, condition: str | None = None) -> Column:
    """Number of distinct non-NULL values of an entity, optionally only some of them."""
    more = f" AND {condition}" if condition else ""
    return F.expr(f"count_if({ENTITY} = '{kind}' AND {column} IS NOT NULL{more})")


def total(kind: str, measure: str) -> Column:
    """Sum of a measure over the groups of one entity, that is over all input rows."""
    return F.expr(f"coalesce(sum(CASE WHEN {ENTITY} = '{kind}' THEN {measure} END), 0L)")


def of(kind: str, value: str) -> Column:
    """A value (SQL expression) only where the row belongs to the entity."""
    return F.expr(f"CASE WHEN {ENTITY} = '{kind}' THEN {value} END")
