"""Raw file rows to bronze rows: parsed time, trimmed text, lineage columns.

Every function works on batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TEXT_COLUMNS = ("event_type", "category_code", "brand", "user_session")


def parse_event_time(c: Column | str) -> Column:
    """Timestamp from text such as ``2019-10-01 00:00:00 UTC``; unreadable text gives NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(F.regexp_replace(c, " UTC$", ""), F.lit(TIME_FORMAT))


def trim_strings(df: DataFrame, columns=TEXT_COLUMNS) -> DataFrame:
    return df.withColumns({c: F.trim(c) for c in columns})


def add_audit(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Add load time, file of origin and creation time.

    The file comes from the scan's hidden metadata, so this must run on a frame
    read straight from files.
    """
    now = F.current_timestamp() if ingested_at is None else ingested_at
    return df.withColumns(
        {
            "ingestion_timestamp": now,
            "source_file": F.col("_metadata.file_path"),
            "created_at": now,
        }
    )


def to_bronze(raw: DataFrame, audit: bool = True, ingested_at: Column | None = None) -> DataFrame:
    """All bronze steps. ``ingested_at`` fixes the load time for repeatable runs."""
    out = add_audit(raw, ingested_at) if audit else raw
    out = out.withColumn("event_time", parse_event_time("event_time"))
    return trim_strings(out)
