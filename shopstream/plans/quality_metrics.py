"""How many raw events survived cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.functions.numerics import pct


def quality_metrics(raw: DataFrame, clean: DataFrame, at: Column | None = None) -> DataFrame:
    """One row: raw, clean and filtered counts and the pass rate in percent.

    Both counts are aggregates of the same lazy plan, the second as a scalar subquery.
    """
    counted = raw.agg(F.count("*").alias("raw_record_count")).withColumn(
        "clean_record_count", clean.agg(F.count("*")).scalar()
    )
    out = counted.withColumns(
        {
            "filtered_record_count": F.col("raw_record_count") - F.col("clean_record_count"),
            "quality_pass_rate": pct("clean_record_count", "raw_record_count"),
        }
    )
    if at is None:
        return out
    return out.select(at.alias("metric_timestamp"), *out.columns)
