"""Bronze rows to cleaned, enriched, unique silver rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstream.operators import quality
from shopstream.schema import EVENT_KEY, SILVER_COLUMNS

UNKNOWN = "unknown"
FIRST_SEEN = ("ingestion_timestamp", "source_file")


def filled(c: str) -> Column:
    """Trimmed text, ``unknown`` where it is absent or blank."""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(UNKNOWN))


def standardize(df: DataFrame) -> DataFrame:
    """One spelling for text columns and a default for absent category and brand."""
    return df.withColumns(
        {
            "event_type": F.lower(F.trim("event_type")),
            "category_code": filled("category_code"),
            "brand": F.lower(filled("brand")),
            "user_session": F.trim("user_session"),
        }
    )


def derive_dates(df: DataFrame) -> DataFrame:
    """Calendar parts of the event time; day of week counts from Sunday = 1, weeks are ISO."""
    t = F.col("event_time")
    return df.withColumns(
        {
            "event_date": F.to_date(t),
            "event_hour": F.hour(t),
            "event_day_of_week": F.dayofweek(t),
            "event_day_of_month": F.dayofmonth(t),
            "event_month": F.month(t),
            "event_year": F.year(t),
            "event_week": F.weekofyear(t),
        }
    )


def category_level(code: Column | str, level: int) -> Column:
    """Part of a dotted category path; ``unknown`` has no parts below the first."""
    return F.get(F.split(code, r"\."), F.lit(level - 1))


def derive_category(df: DataFrame) -> DataFrame:
    return df.withColumns({f"category_l{n}": category_level("category_code", n) for n in (1, 2, 3)})


def event_id(sep: str = "") -> Column:
    """Digest of the event key.

    A missing session hashes as empty text, so such events keep a stable id. The
    parts are joined without a separator to give the ids existing tables
    hold; pass ``sep`` for ids that cannot collide across part borders.
    """
    parts = (
        F.col("event_time").cast("string"),
        F.col("user_id").cast("string"),
        F.col("product_id").cast("string"),
        F.coalesce("user_session", F.lit("")),
        F.col("event_type"),
    )
    return F.sha2(F.concat_ws(sep, *parts), 256)


def deduplicate(
    df: DataFrame, keys: Sequence[str] = EVENT_KEY, order: Sequence[str] = FIRST_SEEN
) -> DataFrame:
    """Keep the first row of every key.

    Ties in ``order`` fall to the remaining columns, so a re-run picks the same row.
    Spark turns ``row_number() = 1`` into a group limit that runs before the
    shuffle as well: a task sends at most one row of a key, however hot the key.
    A missing and an empty session are the same key, as they share an event id.
    """
    by = [F.coalesce(c, F.lit("")) if c == "user_session" else F.col(c) for c in keys]
    lead = [c for c in order if c in df.columns]
    ties = [c for c in df.columns if c not in keys and c not in lead]
    first = Window.partitionBy(*by).orderBy(*lead, *ties) if lead or ties else Window.partitionBy(
        *by
    ).orderBy(*keys)
    return df.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth")


def select_final(df: DataFrame) -> DataFrame:
    """The silver columns in table order, those absent from the frame left out."""
    return df.select(*[name for name, _ in SILVER_COLUMNS if name in df.columns])


def to_silver(
    bronze: DataFrame, dedup: bool = True, audit: bool = True, sep: str = "", by_id: bool = False
) -> DataFrame:
    """Standardise, keep valid rows, drop repeats, then derive.

    Spelling is settled before the rules run, so ``VIEW`` is accepted as ``view``.
    Repeats go before the derived columns exist, which keeps the shuffle narrow.
    On a stream pass ``dedup=False`` and bound the state there. With ``by_id`` repeats are rows of one event id: events of
    different keys whose ids are the same text are one too, as in a table whose key is the id.
    """
    out = quality.filter_valid(standardize(bronze))
    out = out.drop("created_at")
    if dedup and by_id:
        out = deduplicate(out.withColumn("event_id", event_id(sep)), ("event_id",))
    elif dedup:
        out = deduplicate(out)
    out = derive_category(derive_dates(out))
    if "event_id" not in out.columns:
        out = out.withColumn("event_id", event_id(sep))
    if audit:
        out = out.withColumn("processed_timestamp", F.current_timestamp())
    return select_final(out)


def to_quarantine(bronze: DataFrame, at: Column | None = None) -> DataFrame:
    """The bronze rows ``to_silver`` rejects, as they arrived, with the reason.

    Rules see the standardised event type, exactly as in ``to_silver``.
    """
    checked = bronze.withColumns(
        {"_raw_type": F.col("event_type"), "event_type": F.lower(F.trim("event_type"))}
    )
    out = quality.quarantined(checked, at=at)
    return out.withColumn("event_type", F.col("_raw_type")).drop("_raw_type")
