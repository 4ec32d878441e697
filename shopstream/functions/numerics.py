"""Money, rates and conditional counts.

Money is summed as whole ten-thousandths of the currency unit. Integer sums are
exact and do not depend on the order in which tasks finish, they stay in a
fixed-width hash-aggregate buffer, and they turn back into a double only once, at
the end. An overflow (above 9e14 currency units in one group) raises under ANSI.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_UNITS = 10_000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def units(price: Column | str) -> Column:
    """Amount as a whole number of ten-thousandths."""
    return F.round(col(price) * MONEY_UNITS).cast("bigint")


def money(total_units: Column | str) -> Column:
    """Back from ten-thousandths to a double amount."""
    return col(total_units).cast("double") / F.lit(float(MONEY_UNITS))


def rounded(value: Column, scale: int = 2) -> Column:
    """Rounded half up, once. A double is rounded by its shortest decimal form, so a quotient of whole
    numbers that is a tie in decimal counts as one."""
    return F.round(value, scale)


def ratio(num: str, den: str, scale: int = 2) -> Column:
    """Rounded quotient of whole numbers, 0 where the denominator is not positive.

    Numerator and denominator are SQL expressions. A derived table holds dozens of rates,
    and one parsed text per rate is far cheaper for the driver than a tree of Column calls.
    """
    quotient = f"CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)"
    return F.expr(f"round(CASE WHEN {den} > 0 THEN {quotient} ELSE 0D END, {scale})")


def pct(num: str, den: str, scale: int = 2) -> Column:
    """Rounded percentage, 0 where the denominator is not positive."""
    return ratio(f"({num}) * 100", den, scale)


def safe_ratio(num: str, den: str, scale: int = 2) -> Column:
    """Rounded quotient of whole numbers, NULL (never an error) where the denominator is 0."""
    return F.expr(f"round(try_divide(CAST({num} AS DOUBLE), CAST({den} AS DOUBLE)), {scale})")


def amount_units(amount: str) -> str:
    """SQL for an amount as a whole number of ten-thousandths: a quotient of it is exact on ties."""
    return f"round(({amount}) * {MONEY_UNITS})"


def money_ratio(amount: str, den: str, scale: int = 2) -> Column:
    """``ratio`` of an amount of money."""
    return ratio(amount_units(amount), f"({den}) * {MONEY_UNITS}", scale)


def safe_money_ratio(amount: str, den: str, scale: int = 2) -> Column:
    """``safe_ratio`` of an amount of money."""
    return safe_ratio(amount_units(amount), f"({den}) * {MONEY_UNITS}", scale)


def case_when(cases: Iterable[tuple[str, Any]], default: Any = None) -> Column:
    """Value of the first SQL condition that holds, else the default."""
    arms = " ".join(f"WHEN {condition} THEN {_literal(value)}" for condition, value in cases)
    return F.expr(f"CASE {arms} ELSE {_literal(default)} END")


def _literal(value: Any) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else str(value)


def first_match(cases: Iterable[tuple[Column, Any]], default: Any = None) -> Column:
    """The same for Column conditions."""
    chain = F
    for condition, value in cases:
        chain = chain.when(condition, value)
    return chain.otherwise(default)
