"""Partial masking of identifiers and prices. All NULL in, NULL out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopstream.functions.numerics import col, first_match

HIDDEN = "****"

# Upper bounds of the published price bands and their labels.
PRICE_BANDS = ((10, "$0-$10"), (50, "$10-$50"), (100, "$50-$100"), (500, "$100-$500"))
PRICE_TOP_BAND = "$500+"


def mask_user_id(c: Column | str) -> Column:
    """Only the last four digits stay readable."""
    return F.concat(F.lit(HIDDEN), F.right(col(c).cast("string"), F.lit(4)))


def mask_session(c: Column | str) -> Column:
    """Only the first eight characters stay readable."""
    return F.concat(F.left(col(c), F.lit(8)), F.lit(HIDDEN))


def mask_email(c: Column | str) -> Column:
    """First two characters and the domain; a value without ``@`` is hidden whole."""
    c = col(c)
    shown = F.concat(F.left(c, F.lit(2)), F.lit(HIDDEN), F.substr(c, F.instr(c, "@")))
    return F.when(F.instr(c, "@") > 0, shown).when(c.isNotNull(), F.lit(HIDDEN))


def mask_price(c: Column | str) -> Column:
    """The band a price falls in."""
    c = col(c)
    bands = [(c < upper, label) for upper, label in PRICE_BANDS]
    return first_match([*bands, (c.isNotNull(), PRICE_TOP_BAND)])


def digest(c: Column | str) -> Column:
    """Irreversible stand-in that still joins with itself."""
    return F.sha2(col(c).cast("string"), 256)
