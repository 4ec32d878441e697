"""Row filters, column hiding and role-dependent masking.

User and groups are arguments: a plain Spark session knows neither.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.functions.masking import (
    digest,
    mask_email,
    mask_price,
    mask_session,
    mask_user_id,
)

ENGINEERS = "data-engineers"

# Columns of the customer table shown without personal data.
CUSTOMER_PUBLIC = (
    "total_sessions",
    "total_events",
    "total_views",
    "total_cart_adds",
    "total_purchases",
    "customer_lifetime_value",
    "customer_segment",
    "rfm_score",
    "churn_risk",
    "processed_timestamp",
)
# Columns of the masked event view.
EVENTS_SHOWN = (
    "event_id",
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
    "event_date",
    "event_hour",
    "category_l1",
    "category_l2",
    "processed_timestamp",
)

# Partial masks by column; ``hash`` tags use a digest whatever the column.
PARTIAL = {
    "user_id": mask_user_id,
    "user_session": mask_session,
    "email": mask_email,
    "price": mask_price,
}


def can_see(access: DataFrame, user: str, granted: str, value: Column | str) -> Column:
    """Whether a user may see rows with this value; administrators see all, strangers none.

    Both subqueries return one row: a flag, and the set of values one user was granted
    (bounded by the number of segments or categories there are). The filter therefore
    runs inside the scan of the protected table, with no join and no shuffle.
    """
    mine = access.filter(F.col("user_name") == user)
    admin = mine.agg(F.max("is_admin")).scalar()
    values = mine.agg(F.collect_set(granted)).scalar()
    return F.coalesce(admin | F.array_contains(values, value), admin, F.lit(False))


def secure_by_segment(df: DataFrame, access: DataFrame, user: str) -> DataFrame:
    return df.filter(can_see(access, user, "customer_segment", F.col("customer_segment")))


def secure_by_category(df: DataFrame, access: DataFrame, user: str) -> DataFrame:
    return df.filter(can_see(access, user, "category_l1", F.col("category_l1")))


def no_pii(customers: DataFrame) -> DataFrame:
    """Customer table without the user column."""
    return customers.select(*[c for c in CUSTOMER_PUBLIC if c in customers.columns])


def mask_customer(customers: DataFrame, groups: Collection[str] = ()) -> DataFrame:
    """Customer table whose user column only engineers can read."""
    shown = F.col("user_id") if ENGINEERS in groups else F.lit(None).cast("bigint")
    public = [c for c in CUSTOMER_PUBLIC if c in customers.columns]
    return customers.select(shown.alias("user_id"), *public)


def mask_events(events: DataFrame, groups: Collection[str] = ()) -> DataFrame:
    """Event view with price, user and session masked for all but engineers.

    The three columns are text in either case, so the schema does not depend on who asks.
    """
    hidden = ("price", "user_id", "user_session")
    clear = ENGINEERS in groups
    columns = []
    for c in (c for c in EVENTS_SHOWN if c in events.columns):
        if c not in hidden:
            columns.append(F.col(c))
        else:
            columns.append((F.col(c).cast("string") if clear else PARTIAL[c](c)).alias(c))
    return events.select(*columns)


def tag_columns(df: DataFrame, tags: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Record sensitivity tags in the schema, where they survive a Parquet round trip."""
    for name, tag in tags.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "tags": dict(tag)})
    return df


def mask_tagged(
    df: DataFrame,
    tags: Mapping[str, Mapping[str, str]] | None = None,
    groups: Collection[str] = (),
) -> DataFrame:
    """Mask the columns tagged ``pii`` the way their ``mask_type`` says.

    Without ``tags`` those stored in the schema are used. Columns with a partial mask of
    unknown form are hashed rather than shown.
    """
    if ENGINEERS in groups:
        return df
    if tags is None:
        tags = {f.name: f.metadata["tags"] for f in df.schema if "tags" in f.metadata}
    masked = {}
    for name, tag in tags.items():
        if tag.get("pii") == "true" and name in df.columns:
            partial = tag.get("mask_type") == "partial" and name in PARTIAL
            masked[name] = PARTIAL[name](name) if partial else digest(name)
    return df.withColumns(masked) if masked else df


def access_coverage(views: Mapping[str, tuple[DataFrame, str]], access: DataFrame) -> DataFrame:
    """Rows each user can see in each protected view.

    ``views`` maps a view name to its table and the column that is granted on. Tables
    are first counted per value of that column, so the joins are between small sides.
    """
    out = None
    for name, (df, column) in views.items():
        per_value = df.groupBy(column).agg(F.count("*").alias("_n"))
        grants = access.select("user_name", column).distinct()
        matched = grants.join(per_value, column, "left").groupBy("user_name").agg(
            F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias("_matched")
        )
        admins = access.groupBy("user_name").agg(F.max("is_admin").alias("_admin"))
        everything = df.agg(F.count("*")).scalar()
        part = matched.join(admins, "user_name").select(
            F.lit(name).alias("view_name"),
            "user_name",
            F.when(F.col("_admin"), everything).otherwise(F.col("_matched")).alias("visible_rows"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def audit_daily(audit: DataFrame, resource: str) -> DataFrame:
    """Queries and distinct users per day on resources whose name contains ``resource``."""
    return (
        audit.filter(F.col("request_params.full_name_arg").contains(resource))
        .groupBy(F.to_date("event_time").alias("access_date"))
        .agg(
            F.count("*").alias("total_queries"),
            F.count_distinct("user_identity.email").alias("unique_users"),
        )
        .orderBy(F.desc("access_date"))
    )


# Names and bodies of the masking functions for SQL users.
SQL_MASKS = {
    "mask_user_id(user_id BIGINT)": "concat('****', right(cast(user_id AS STRING), 4))",
    "mask_session(session_id STRING)": "concat(left(session_id, 8), '****')",
    "mask_email(email STRING)": (
        "CASE WHEN instr(email, '@') > 0 "
        "THEN concat(left(email, 2), '****', substring(email, instr(email, '@'))) "
        "WHEN email IS NOT NULL THEN '****' END"
    ),
    "mask_price(price DOUBLE)": (
        "CASE WHEN price IS NULL THEN NULL WHEN price < 10 THEN '$0-$10' "
        "WHEN price < 50 THEN '$10-$50' WHEN price < 100 THEN '$50-$100' "
        "WHEN price < 500 THEN '$100-$500' ELSE '$500+' END"
    ),
}


def register_sql_masks(spark) -> None:
    """Make the masks available to SQL text of this session."""
    for signature, body in SQL_MASKS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS STRING RETURN {body}")
