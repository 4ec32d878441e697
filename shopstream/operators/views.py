"""Protected tables as SQL views that look up who asks when they are queried.

User and groups are session variables, since plain Spark knows neither; whoever opens a session for a user sets them with
``act_as`` and hands out the views. The views hold no rows and no rights of their own: change the variables or the access
table and the next query answers accordingly.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession

from shopstream.operators.security import CUSTOMER_PUBLIC, ENGINEERS, EVENTS_SHOWN, register_sql_masks

USER, GROUPS, ACCESS = "shop_user", "shop_groups", "user_segment_access"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def act_as(spark: SparkSession, user: str, groups: Collection[str] = ()) -> None:
    """Whom the views of this session answer."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {USER} STRING DEFAULT {_text(user)}")
    members = ", ".join(_text(g) for g in groups)
    spark.sql(f"DECLARE OR REPLACE VARIABLE {GROUPS} ARRAY<STRING> DEFAULT CAST(array({members}) AS ARRAY<STRING>)")


def _granted(column: str) -> str:
    """Whether the user may see a value, as the body of a function.

    The subqueries hold one row each and do not depend on the row at hand: a protected table is filtered inside its scan.
    """
    mine = f"FROM {ACCESS} WHERE user_name = session.{USER}"
    return (
        f"coalesce((SELECT max(is_admin) {mine}), false) "
        f"OR coalesce(array_contains((SELECT collect_set({column}) {mine}), wanted), false)"
    )


def register_functions(spark: SparkSession) -> None:
    """``is_member``, the access checks and the masks for SQL users. Needs ``act_as`` and the access table as a view."""
    bodies = {
        "is_member(name STRING)": f"array_contains(session.{GROUPS}, name)",
        "check_segment_access(wanted STRING)": _granted("customer_segment"),
        "check_category_access(wanted STRING)": _granted("category_l1"),
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS BOOLEAN RETURN {body}")
    register_sql_masks(spark)


def create_views(
    spark: SparkSession, access: DataFrame, customers: DataFrame, products: DataFrame, events: DataFrame
) -> list[str]:
    """Views on the access map, customer, product and silver tables; returns the names of the protected ones.

    ``customer_metrics_secured`` and ``product_performance_secured`` show rows of granted segments and categories,
    all to administrators, none to strangers. ``customer_metrics_no_pii`` lacks the user, ``customer_metrics_masked`` shows it to engineers only,
    ``events_cleaned_masked`` masks price, user and session for everyone else, always as text.
    """
    for name, df in ((ACCESS, access), ("customer_metrics", customers), ("product_performance", products), ("events_cleaned", events)):
        df.createOrReplaceTempView(name)
    register_functions(spark)
    public = ", ".join(c for c in CUSTOMER_PUBLIC if c in customers.columns)
    engineer = f"is_member({_text(ENGINEERS)})"
    masks = {"price": "mask_price", "user_id": "mask_user_id", "user_session": "mask_session"}
    shown = ", ".join(
        f"CASE WHEN {engineer} THEN CAST({c} AS STRING) ELSE {masks[c]}({c}) END AS {c}" if c in masks else c
        for c in EVENTS_SHOWN
        if c in events.columns
    )
    views = {
        "customer_metrics_secured": "SELECT * FROM customer_metrics WHERE check_segment_access(customer_segment)",
        "product_performance_secured": "SELECT * FROM product_performance WHERE check_category_access(category_l1)",
        "customer_metrics_no_pii": f"SELECT {public} FROM customer_metrics",
        "customer_metrics_masked": f"SELECT CASE WHEN {engineer} THEN user_id END AS user_id, {public} FROM customer_metrics",
        "events_cleaned_masked": f"SELECT {shown} FROM events_cleaned",
    }
    for name, body in views.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {body}")
    return list(views)
