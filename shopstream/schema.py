"""Event schemas, keys and column checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The event vocabulary and the accepted price interval.
EVENT_TYPES = ("view", "cart", "remove_from_cart", "purchase")
PRICE_MIN = 0.0
PRICE_MAX = 100000.0

# One event is one occurrence of this combination.
EVENT_KEY = ("event_time", "user_id", "product_id", "user_session", "event_type")
REQUIRED = ("event_time", "event_type", "product_id", "user_id", "price")

# Source columns in file order, as (name, type when parsed, meaning).
EVENT_COLUMNS = (
    ("event_time", "timestamp", "moment of the event, UTC"),
    ("event_type", "string", "view, cart, remove_from_cart or purchase"),
    ("product_id", "bigint", "product"),
    ("category_id", "bigint", "category of the product"),
    ("category_code", "string", "dotted category path, may be absent"),
    ("brand", "string", "brand name in lower case, may be absent"),
    ("price", "double", "price in shop currency"),
    ("user_id", "bigint", "permanent user"),
    ("user_session", "string", "session, renewed after a long pause"),
)
AUDIT_COLUMNS = (
    ("ingestion_timestamp", "timestamp", "when the row was loaded"),
    ("source_file", "string", "file the row came from"),
    ("created_at", "timestamp", "when the table row was made"),
)
SILVER_COLUMNS = (
    ("event_id", "string"),
    ("event_time", "timestamp"),
    ("event_type", "string"),
    ("product_id", "bigint"),
    ("category_id", "bigint"),
    ("category_code", "string"),
    ("brand", "string"),
    ("price", "double"),
    ("user_id", "bigint"),
    ("user_session", "string"),
    ("event_date", "date"),
    ("event_hour", "int"),
    ("event_day_of_week", "int"),
    ("event_day_of_month", "int"),
    ("event_month", "int"),
    ("event_year", "int"),
    ("event_week", "int"),
    ("category_l1", "string"),
    ("category_l2", "string"),
    ("category_l3", "string"),
    ("source_file", "string"),
    ("ingestion_timestamp", "timestamp"),
    ("processed_timestamp", "timestamp"),
)

# Text of a record that could not be read as it stands; only where a reader was asked to keep it.
MALFORMED = "malformed_line"

_SPARK_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


def _struct(columns: Iterable[tuple], overrides: dict[str, str] | None = None) -> T.StructType:
    overrides = overrides or {}
    out = T.StructType()
    for name, kind, *doc in columns:
        out = out.add(
            name,
            _SPARK_TYPES[overrides.get(name, kind)],
            True,
            {"comment": doc[0]} if doc else None,
        )
    return out


# Times arrive as text with a zone suffix and are parsed by the bronze step.
RAW_SCHEMA = _struct(EVENT_COLUMNS, {"event_time": "string"})
BRONZE_SCHEMA = _struct((*EVENT_COLUMNS, *AUDIT_COLUMNS))
SILVER_SCHEMA = _struct(SILVER_COLUMNS)
ACCESS_SCHEMA = _struct(
    (
        ("user_name", "string"),
        ("customer_segment", "string"),
        ("category_l1", "string"),
        ("is_admin", "boolean"),
    )
)


def type_of(column: str) -> str:
    """Spark type name expected for an event column; text when unknown."""
    kinds = {name: kind for name, kind, _ in EVENT_COLUMNS}
    return kinds.get(column, "string")


def check_columns(df: DataFrame, expected: Iterable[str]) -> tuple[bool, list[str], list[str]]:
    """Return (complete, missing, extra); extra columns alone do not fail the check."""
    have, want = set(df.columns), set(expected)
    missing = sorted(want - have)
    return not missing, missing, sorted(have - want)
