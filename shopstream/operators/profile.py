"""First look at raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.sources.csv_events import read_events_csv


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of NULLs in every column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def profile_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows and NULLs per column of each CSV file, in one scan with inferred types."""
    raw = read_events_csv(spark, path, infer=True)
    return (
        raw.groupBy(F.col("_metadata.file_name").alias("source_file"))
        .agg(
            F.count("*").alias("row_count"),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in raw.columns],
        )
        .orderBy("source_file")
    )
