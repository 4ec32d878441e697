"""Who may see what: the access map behind the row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopstream.schema import ACCESS_SCHEMA

# The seed grants (user, segment, top category, administrator).
SEED_GRANTS = (
    ("analyst1@company.com", "Champion", "electronics", False),
    ("analyst1@company.com", "Loyal", "electronics", False),
    ("analyst2@company.com", "Champion", "appliances", False),
    ("admin@company.com", None, None, True),
)


def access_map(spark: SparkSession, grants=SEED_GRANTS) -> DataFrame:
    """Grants as a DataFrame; an omitted administrator flag means no."""
    rows = [(*g[:3], bool(g[3]) if len(g) > 3 else False) for g in grants]
    return spark.createDataFrame(rows, ACCESS_SCHEMA)
