"""Catalog tables: bucketed for joins without a shuffle, described, and with statistics the optimiser uses."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from shopstream.sources import tables


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Replace a catalog table by these rows, dealt to buckets of ``key`` and sorted in them.

    Two tables bucketed alike are joined or looked up by ``key`` without moving either; one of them, without moving that one. Rows are
    shuffled by the key before, so that there is a file a bucket and not one a task and bucket. Take buckets for
    about a gigabyte each at the table's full size; a key that holds much of the table makes its bucket large, as it
    would make a join's task.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def describe(
    spark: SparkSession,
    name: str,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
    columns: Mapping[str, str] | None = None,
) -> None:
    """Store a table's comment and properties and the comments of its columns, save partition columns, in the catalog."""
    spark.sql(f"COMMENT ON TABLE {name} IS {_text(comment)}")
    if properties:
        pairs = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in sorted(properties.items()))
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
    there = {c.name for c in spark.catalog.listColumns(name) if not c.isPartition}
    for column, meaning in (columns or {}).items():
        if column in there:
            spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{column}` COMMENT {_text(meaning)}")


def details(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog says of a table: its comment, provider, statistics and so on."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    at = next((i for i, r in enumerate(rows) if r.col_name.startswith("# Detailed Table")), len(rows))
    return {r.col_name: r.data_type for r in rows[at + 1 :] if r.col_name}


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def counted_rows(spark: SparkSession, name: str) -> int | None:
    """Number of rows by the stored statistics; None if there are none."""
    found = re.search(r"(\d+) rows", details(spark, name).get("Statistics", ""))
    return int(found[1]) if found else None


def column_statistics(spark: SparkSession, name: str, column: str) -> dict[str, str]:
    """min, max, num_nulls, distinct_count and so on, by the stored statistics; they say NULL where nothing is known."""
    return {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {name} `{column}`").collect()}


def register(
    spark: SparkSession,
    name: str,
    path: str,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
    columns: Mapping[str, str] | None = None,
    statistics: Sequence[str] = (),
) -> DataFrame:
    """Give files at a path a described catalog name; with ``statistics`` those columns are analysed.

    With ``spark.sql.cbo.enabled`` the optimiser orders joins and sizes their sides by these figures. Run it again
    after loads: statistics do not follow the files.
    """
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE {name}")  # the files stay, the table is external
    tables.register_external(spark, name, path)
    describe(spark, name, comment, properties, columns)
    there = [c for c in statistics if c in spark.table(name).columns]
    if there:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(there)}")
    return spark.table(name)
