"""Raw event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.schema import MALFORMED, RAW_SCHEMA


def read_events_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_SCHEMA,
    infer: bool = False,
    keep_malformed: bool = False,
) -> DataFrame:
    """Scan a folder of headed CSV files; anything not named ``*.csv`` is left out.

    The schema is given unless ``infer`` asks for a profiling read. Malformed
    numbers become NULL and end in quarantine instead of failing the load; with ``keep_malformed`` the whole line of such a
    record, and of one with too few or too many fields, comes along in a column of its own.
    """
    reader = spark.read.option("header", True).option("pathGlobFilter", "*.csv")
    if infer:
        return reader.option("inferSchema", True).csv(path)
    if keep_malformed:
        schema, reader = with_malformed(schema), reader.option("columnNameOfCorruptRecord", MALFORMED)
    return reader.schema(schema).csv(path)


def with_malformed(schema: T.StructType) -> T.StructType:
    """A schema with a place for the text of records that do not fit it."""
    return schema if MALFORMED in schema.names else T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])


def write_events_csv(bronze: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write bronze events in the raw file form (times as text with a UTC suffix)."""
    text_time = F.concat(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))
    (
        bronze.withColumn("event_time", text_time)
        .select(*RAW_SCHEMA.names)
        .write.mode(mode)
        .option("header", True)
        .csv(path)
    )
