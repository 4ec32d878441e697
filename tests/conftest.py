"""One session for all tests, and the fixed event sets they share."""

from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopstream import get_spark  # noqa: E402
from shopstream.operators.silver import derive_category, derive_dates, event_id  # noqa: E402
from shopstream.schema import BRONZE_SCHEMA, RAW_SCHEMA  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        "local[4]",
        4,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


# A garden and household shop. One visitor (Ann, 901) buys seeds, Bo (902) pays for a lamp of unlisted
# category without a session, Cem (903) looks at a pan of no brand.
_RAKE = ("garden.tools.rake", "birchwood", 24.5)
_SEEDS = ("garden.seeds", "sproutco", 3.2)
_LAMP = ("lighting.lamps", "lumen", 61.75)

RAW_ROWS = [
    ("2021-03-08 07:14:09 UTC", "view", 31, 410, *_RAKE, 901, "ann-1"),
    ("2021-03-08 07:20:41 UTC", "view", 47, 412, "garden.seeds", None, 3.2, 901, "ann-1"),
    ("2021-03-08 07:21:02 UTC", "cart", 47, 412, "garden.seeds", None, 3.2, 901, "ann-1"),
    ("2021-03-08 18:55:30 UTC", "remove_from_cart", 47, 412, "garden.seeds", None, 3.2, 901, "ann-2"),
    ("2021-03-09 21:05:00 UTC", "purchase", 52, 430, None, "lumen", 61.75, 902, None),
    ("2021-03-09 21:05:00 UTC", "view", 60, 431, "kitchen.pans", "", 18.0, 903, "cem-1"),
]

# One row for each kind of dirt: a copy, capitals with padding, absent and blank text, a refund booked
# as a negative price, a time that was not readable.
DIRTY_ROWS = [
    ("2021-03-10 06:30:00", "view", 31, 410, *_RAKE, 901, "ann-3"),
    ("2021-03-10 06:31:30", "cart", 31, 410, *_RAKE, 901, "ann-3"),
    ("2021-03-10 06:30:00", "view", 31, 410, *_RAKE, 901, "ann-3"),
    ("2021-03-10 09:00:15", "CART", 47, 412, "  garden.seeds ", " sproutco  ", 3.2, 902, "bo-1"),
    ("2021-03-10 11:45:00", "view", 52, 430, None, None, 61.75, 902, "bo-1"),
    ("2021-03-10 11:46:00", "remove_from_cart", 60, 431, "", "  ", 18.0, 903, "cem-2"),
    ("", "purchase", 53, 430, *_LAMP, 904, "dia-1"),
    ("2021-03-10 12:00:00", "view", 75, 433, "lighting.bulbs", "lumen", -4.0, 904, "dia-1"),
    ("2021-03-10 23:59:59", "purchase", 80, 440, "kitchen", "panco", 44.0, 905, "edo-1"),
]

# Ann buys seeds on Thursday and, without a cart, a rake on Friday. Bo puts a lamp back. Cem only looks.
SILVER_ROWS = [
    ("2021-03-11 08:00:00", "view", 31, *_RAKE, 901, "ann-4"),
    ("2021-03-11 08:04:00", "view", 47, *_SEEDS, 901, "ann-4"),
    ("2021-03-11 08:05:00", "cart", 47, *_SEEDS, 901, "ann-4"),
    ("2021-03-11 08:09:00", "purchase", 47, *_SEEDS, 901, "ann-4"),
    ("2021-03-11 09:30:00", "view", 52, *_LAMP, 902, "bo-2"),
    ("2021-03-11 09:31:00", "cart", 52, *_LAMP, 902, "bo-2"),
    ("2021-03-11 09:40:00", "remove_from_cart", 52, *_LAMP, 902, "bo-2"),
    ("2021-03-12 07:00:00", "view", 31, *_RAKE, 903, "cem-3"),
    ("2021-03-12 07:02:00", "view", 80, "kitchen", "panco", 44.0, 903, "cem-3"),
    ("2021-03-12 07:03:00", "view", 52, *_LAMP, 903, "cem-3"),
    ("2021-03-12 20:15:00", "view", 31, *_RAKE, 901, "ann-5"),
    ("2021-03-12 20:16:00", "purchase", 31, *_RAKE, 901, "ann-5"),
]

LOADED = at("2021-04-01 00:00:00")


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RAW_ROWS, RAW_SCHEMA)


def bronze_rows(rows, loaded=LOADED, file="a.csv"):
    return [(at(r[0]), *r[1:], loaded, file, loaded) for r in rows]


@pytest.fixture
def dirty(spark):
    return spark.createDataFrame(bronze_rows(DIRTY_ROWS), BRONZE_SCHEMA)


def make_silver(spark, rows):
    """Silver rows from (time, type, product, category path, brand, price, user, session)."""
    full = [(at(t), k, p, 400 + p, c, b, x, u, s, LOADED, "a.csv", LOADED) for t, k, p, c, b, x, u, s in rows]
    df = derive_category(derive_dates(spark.createDataFrame(full, BRONZE_SCHEMA)))
    return df.withColumn("event_id", event_id()).drop("created_at")


@pytest.fixture
def silver(spark):
    return make_silver(spark, SILVER_ROWS)


@pytest.fixture(scope="session")
def shop(spark):
    """Silver events of the smallest test set, written once."""
    from workload import queries

    return queries.clean(spark, TESTDATA)


def rows_of(df, *columns):
    """Rows as sorted tuples, for order-free comparison."""
    picked = df.select(*columns) if columns else df.select(*sorted(df.columns))
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def by_key(df, key):
    return {r[key]: r for r in df.collect()}
