"""Every registered query, as a function of (session, folder of test tables).

As in the pipeline itself, gold queries read a written silver table and reports read
written gold tables. They are made from the given tables on first use in a session and
kept below the shared folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import datetime
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.functions import masking
from shopstream.operators import audience, dims, maintenance, publish, quality, security, silver, upsert, views
from shopstream.operators import profile as profiling
from shopstream.operators.bronze import to_bronze
from shopstream.plans import customer, daily, funnel, product, reports
from shopstream.plans.pipeline import TABLES, period_audience, register_tables, run_batch
from shopstream.plans.quality_metrics import quality_metrics
from shopstream.schema import MALFORMED, RAW_SCHEMA, check_columns
from shopstream.session import configure, scratch_path, shared_dir
from shopstream.sources import catalog, tables
from shopstream.sources.access import access_map
from shopstream.sources.adapters import (
    events_from_orders,
    events_from_testdata,
    read_parquet,
)
from shopstream.sources.csv_events import read_events_csv, write_events_csv
from shopstream.streaming import events as streaming
from shopstream.streaming import history
from shopstream.streaming import late as set_aside
from shopstream.streaming.ledger import SchemaLedger

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-01-31"
ORDERS_AS_OF = "2024-12-15"
LAST_LOAD_DAY = "2024-01-25"
DAY_RANGE = ("2024-01-10", "2024-01-16")
CATEGORY = "economy"
JOURNEY_USER = 7
SEGMENT_USER = "analyst1@company.com"
GRANTS = (
    ("analyst1@company.com", "Champion", "economy", False),
    ("analyst1@company.com", "Loyal", "economy", False),
    ("analyst2@company.com", "Champion", "small", False),
    ("admin@company.com", None, None, True),
)
TAGS = {
    "user_id": {"pii": "true", "mask_type": "partial"},
    "user_session": {"pii": "true", "mask_type": "hash"},
    "price": {"sensitivity": "internal"},
}

_made: dict[tuple[str, str, str], str] = {}


def staged(spark: SparkSession, sf_dir: str, name: str, make, partition_by=()) -> DataFrame:
    """Write a table once per session, and again after the given tables have changed, and read it back from then on."""
    given = sf_dir + tables.stamp(spark, sf_dir)
    key = (spark.sparkContext.applicationId, given, name)
    if key not in _made or not tables.exists(spark, _made[key]):
        digest = hashlib.sha256(given.encode()).hexdigest()[:10]
        path = f"{shared_dir(spark)}/shopstream/{key[0]}/staged/{digest}/{name}"
        tables.write_full(make(), path, partition_by, staged=False)
        _made[key] = path
    return tables.read_table(spark, _made[key])


# Inputs

def bronze(spark, d):
    return events_from_testdata(spark, d)


def clean(spark, d):
    return staged(
        spark, d, "silver", lambda: silver.to_silver(bronze(spark, d), audit=False), ["event_date"]
    )


def orders_clean(spark, d):
    """The orders' silver without lineage and id, which no gold table reads: the digest alone would be most of the files.

    All copies of an event have the same lineage, so the copy that stays is the same one without.
    """
    def make():
        read = events_from_orders(spark, d).drop("ingestion_timestamp", "source_file")
        return silver.to_silver(read, audit=False).drop("event_id")

    return staged(spark, d, "orders_silver", make)


def customers(spark, d):
    return staged(spark, d, "customers", lambda: customer.customer_metrics(clean(spark, d), AS_OF))


def products(spark, d):
    return staged(spark, d, "products", lambda: product.product_performance(clean(spark, d)))


def days(spark, d):
    return staged(spark, d, "days", lambda: daily.daily_sales_summary(clean(spark, d)))


def stages(spark, d):
    return staged(spark, d, "funnel", lambda: funnel.conversion_funnel(clean(spark, d)))


def csv_folder(spark, d):
    """The valid first deliveries as CSV files with second-precision times."""
    key = (spark.sparkContext.applicationId, d + tables.stamp(spark, d), "csv")
    if key not in _made or not tables.exists(spark, _made[key]):
        path = scratch_path(spark, "csv")
        write_events_csv(events_from_testdata(spark, d), path)
        _made[key] = path
    return _made[key]


NO_AUDIT = ("source_file", "ingestion_timestamp", "created_at", "processed_timestamp")


def plain(df: DataFrame) -> DataFrame:
    """Without load-dependent columns."""
    return df.drop(*NO_AUDIT)


# Bronze and silver

def bronze_parse(spark, d):
    text = F.concat(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))
    raw = bronze(spark, d).withColumn("event_time", text)
    return plain(to_bronze(raw, audit=False))


def csv_roundtrip(spark, d):
    return plain(to_bronze(read_events_csv(spark, csv_folder(spark, d))))


def silver_clean(spark, d):
    return plain(silver.to_silver(bronze(spark, d), dedup=False, audit=False))


def silver_dedup(spark, d):
    return silver.to_silver(bronze(spark, d), audit=False)


def event_id(spark, d):
    return clean(spark, d).select("event_id", "event_time", "user_id", "product_id")


def category_levels(spark, d):
    return clean(spark, d).groupBy("category_code", "category_l1", "category_l2", "category_l3").agg(
        F.count("*").alias("n")
    )


def date_parts(spark, d):
    return (
        silver.derive_dates(bronze(spark, d).select("event_time"))
        .groupBy(
            "event_date", "event_hour", "event_day_of_week", "event_day_of_month", "event_month",
            "event_year", "event_week",
        )
        .agg(F.count("*").alias("n"))
    )


# Quality

def filter_valid(spark, d):
    return plain(quality.filter_valid(bronze(spark, d)))


def orders_filter_valid(spark, d):
    return plain(quality.filter_valid(events_from_orders(spark, d)))


def quarantine(spark, d):
    return plain(silver.to_quarantine(bronze(spark, d)))


def quarantine_reasons(spark, d):
    both = bronze(spark, d).unionByName(events_from_orders(spark, d))
    return silver.to_quarantine(both).groupBy("quarantine_reason").agg(F.count("*").alias("n"))


def expectation_counts(spark, d):
    return quality.expectation_counts(bronze(spark, d))


def expectations_apply(spark, d):
    return plain(quality.apply(silver.standardize(bronze(spark, d)), quality.EXPECTATIONS))


def expectations_warn(spark, d):
    kept = quality.apply(bronze(spark, d), quality.EXPECTATIONS, "warn")
    return kept.groupBy(F.array_join("failed_expectations", ",").alias("failed")).agg(
        F.count("*").alias("n")
    )


def quality_report(spark, d):
    return quality.report(bronze(spark, d))


def completeness_flags(spark, d):
    flagged = quality.flag_completeness(bronze(spark, d), ["category_code", "brand", *quality.REQUIRED])
    return flagged.groupBy(
        F.array_join("completeness_issues", ",").alias("issues"), "is_complete"
    ).agg(F.count("*").alias("n"))


def validity_flags(spark, d):
    rows = bronze(spark, d).unionByName(events_from_orders(spark, d))
    flagged = quality.flag_ids(quality.flag_price(quality.flag_event_type(rows)))
    names = [c for c in flagged.columns if c.startswith("is_valid")]
    return flagged.groupBy(*names).agg(F.count("*").alias("n"))


def duplicate_count(spark, d):
    return quality.count_duplicates(silver.standardize(bronze(spark, d)))


def duplicate_rows(spark, d):
    return quality.duplicate_rows(silver.standardize(bronze(spark, d))).drop("created_at")



# Incremental loads

def _old_and_new(spark, d):
    """Events up to a day as the existing table, the week around it as a re-delivered batch."""
    rows = clean(spark, d)
    day = F.lit(LAST_LOAD_DAY).cast("date")
    old = rows.filter(F.col("event_date") <= day)
    batch = rows.filter(F.col("event_date") >= F.date_sub(day, 3))
    return old, batch.withColumn("price", F.col("price") + 1.0)


def insert_new(spark, d):
    old, batch = _old_and_new(spark, d)
    return plain(upsert.insert_new(old, batch))


def upsert_rows(spark, d):
    old, batch = _old_and_new(spark, d)
    return plain(upsert.upsert(old, batch))


def upsert_table(spark, d):
    old, batch = _old_and_new(spark, d)
    path = scratch_path(spark, "upsert")
    upsert.upsert_table(old, path)
    upsert.upsert_table(batch, path)
    upsert.upsert_table(batch, path)
    return plain(tables.read_table(spark, path))


# Gold

def customer_agg(spark, d):
    return customer.aggregate(clean(spark, d))


def customer_metrics(spark, d):
    return customer.customer_metrics(clean(spark, d), AS_OF)


def customer_core(spark, d):
    return customer.customer_metrics(clean(spark, d), AS_OF, columns="core")


def customer_latest_day(spark, d):
    """Recency from the last day in the data."""
    out = customer.customer_metrics(clean(spark, d))
    return out.select("user_id", "days_since_last_activity", "recency_score", "churn_risk")


def product_agg(spark, d):
    return product.aggregate(clean(spark, d))


def product_derived(spark, d):
    return product.derive(product.aggregate(clean(spark, d)))


def product_performance(spark, d):
    return product.product_performance(clean(spark, d))


def product_rank_scalable(spark, d):
    out = product.product_performance(clean(spark, d))
    return out.select(
        "product_id", "revenue_rank_global", "revenue_percentile", "revenue_rank_in_category",
        "revenue_rank_in_brand", "performance_tier",
    )


def product_core(spark, d):
    return product.product_performance(clean(spark, d), columns="core")


def daily_agg(spark, d):
    return daily.aggregate(clean(spark, d))


def daily_sales_summary(spark, d):
    return daily.daily_sales_summary(clean(spark, d))


def daily_calendar_frames(spark, d):
    """Rolling figures over calendar days, on data with missing days."""
    out = daily.daily_sales_summary(orders_clean(spark, d), frame="days")
    return out.select("event_date", "revenue_7d_avg", "users_7d_avg", "revenue_30d_total")


def daily_core(spark, d):
    return daily.daily_sales_summary(clean(spark, d), columns="core")


def funnel_agg(spark, d):
    return funnel.aggregate(clean(spark, d))


def funnel_expand(spark, d):
    return funnel.aggregate(clean(spark, d), strategy="expand")


def conversion_funnel(spark, d):
    return funnel.conversion_funnel(clean(spark, d))


def funnel_core(spark, d):
    return funnel.conversion_funnel(clean(spark, d), columns="core")


def data_quality_metrics(spark, d):
    return quality_metrics(bronze(spark, d), clean(spark, d))


def orders_customers(spark, d):
    return customer.aggregate(orders_clean(spark, d))


def orders_customer_metrics(spark, d):
    """The orders with few, many and no purchases, and as of the middle of their years: all segments, scores and risks."""
    few = F.expr("event_type <> 'purchase' OR user_id % 6 IN (0, 1) OR (user_id % 6 = 2 AND product_id % 3 = 0)")
    rare = F.expr("user_id % 9 <> 4 OR event_type = 'view'")
    poor = F.expr("user_id % 9 <> 5 OR (event_type = 'view' AND product_id % 20 = 0)")
    some = orders_clean(spark, d).filter(few & rare & poor)
    return customer.customer_metrics(some, ORDERS_AS_OF)


def orders_products(spark, d):
    return product.product_performance(orders_clean(spark, d))


def orders_daily(spark, d):
    return daily.daily_sales_summary(orders_clean(spark, d))


def orders_funnel(spark, d):
    return funnel.conversion_funnel(orders_clean(spark, d))


# Dimensions

def products_dim(spark, d):
    return dims.products_dim(clean(spark, d))


def users_dim(spark, d):
    return dims.users_dim(clean(spark, d))


def enrich(spark, d):
    rows = clean(spark, d).select("event_id", "product_id", "event_type", "price")
    return dims.enrich(rows, dims.products_dim(clean(spark, d)), "product_id", ["brand", "category_l1", "price"])


# Reports

def _on(table, report, *args, **kwargs) -> Query:
    return lambda spark, d: report(table(spark, d), *args, **kwargs)


def events_between(spark, d):
    return plain(reports.events_between(clean(spark, d), *DAY_RANGE))


def user_journey(spark, d):
    return plain(reports.user_journey(clean(spark, d), JOURNEY_USER))


def purchases_in_category(spark, d):
    return plain(reports.purchases_in_category(clean(spark, d), CATEGORY))


# Security

def mask_functions(spark, d):
    people = read_parquet(spark, d, "customer").select(
        "c_custkey", F.concat("c_name", F.lit("@"), F.lower("c_mktsegment"), F.lit(".example")).alias("email"), "c_name"
    )
    rows = clean(spark, d).join(people, F.col("user_id") == F.col("c_custkey"), "left")
    return rows.select(
        "event_id",
        masking.mask_user_id("user_id").alias("user_id"),
        masking.mask_session("user_session").alias("user_session"),
        masking.mask_price("price").alias("price_band"),
        masking.mask_email("email").alias("email"),
        masking.mask_email("c_name").alias("not_an_email"),
    )


def secure_by_segment(spark, d):
    return security.secure_by_segment(customers(spark, d), access_map(spark, GRANTS), SEGMENT_USER)


def secure_by_category(spark, d):
    return security.secure_by_category(products(spark, d), access_map(spark, GRANTS), SEGMENT_USER)


def secure_as_admin(spark, d):
    seen = security.secure_by_category(products(spark, d), access_map(spark, GRANTS), "admin@company.com")
    return seen.select("product_id", "category_l1")


def no_pii(spark, d):
    return security.no_pii(customers(spark, d))


def mask_customer(spark, d):
    return security.mask_customer(customers(spark, d), groups=["data-analysts"])


def mask_events(spark, d):
    return security.mask_events(clean(spark, d), groups=["data-analysts"])


def mask_events_engineer(spark, d):
    return security.mask_events(clean(spark, d), groups=["data-engineers"])


def mask_customer_engineer(spark, d):
    return security.mask_customer(customers(spark, d), groups=["data-engineers"])


def mask_tagged(spark, d):
    rows = clean(spark, d).select("event_id", "user_id", "user_session", "price")
    return security.mask_tagged(security.tag_columns(rows, TAGS))


def access_coverage(spark, d):
    views = {
        "customer_metrics": (customers(spark, d), "customer_segment"),
        "product_performance": (products(spark, d), "category_l1"),
    }
    return security.access_coverage(views, access_map(spark, GRANTS))


def audit_daily(spark, d):
    events = read_parquet(spark, d, "events")
    audit = events.select(
        F.col("ts").cast("timestamp").alias("event_time"),
        F.struct(F.concat(F.col("user_id").cast("string"), F.lit("@company.com")).alias("email")).alias(
            "user_identity"
        ),
        F.struct(F.concat(F.lit("shop.gold."), F.col("event_type")).alias("full_name_arg")).alias(
            "request_params"
        ),
    )
    return security.audit_daily(audit, "gold.p")


# Streaming: each query drains the files of one folder and reads what the sink holds.

def _bronze_stream(spark, d):
    return to_bronze(streaming.read_event_stream(spark, csv_folder(spark, d)))


def _drained(spark, df, partition_by):
    target, checkpoint = scratch_path(spark, "sink"), scratch_path(spark, "stream")
    streaming.run_available(streaming.start_append(df, target, checkpoint, partition_by))
    return tables.read_table(spark, target)


def stream_bronze(spark, d):
    return plain(_drained(spark, _bronze_stream(spark, d), ["event_type"]))


def stream_silver(spark, d):
    """All files in one micro-batch, copies dropped from the stream's own state."""
    out = streaming.silver_stream(_bronze_stream(spark, d), dedup_delay="1 day", audit=False)
    return plain(_drained(spark, out, ["event_date"]))


def stream_late(spark, d):
    """The same events in several micro-batches, the latest days first: late events and late copies arrive.

    One micro-batch a delivery: each looks its keys up in the table, so batches of a fixed number of files would do so ever more often.
    """
    target, checkpoint = scratch_path(spark, "silver"), scratch_path(spark, "stream")

    def start(folders):
        events = streaming.silver_stream(to_bronze(streaming.read_event_stream(spark, folders)), audit=False)
        return streaming.insert_silver(events, target, checkpoint)

    _each_delivery(spark, d, start, LATE_DELIVERIES)
    return plain(tables.read_table(spark, target))


def stream_quarantine(spark, d):
    out = streaming.quarantine_stream(_bronze_stream(spark, d))
    return plain(_drained(spark, out, []).drop("quarantine_timestamp"))


def stream_upsert(spark, d):
    target, checkpoint = scratch_path(spark, "merged"), scratch_path(spark, "stream")
    rows = streaming.silver_stream(_bronze_stream(spark, d), dedup_delay=None, audit=False)
    streaming.run_available(streaming.upsert_stream(rows, target, checkpoint))
    return plain(tables.read_table(spark, target))


# Three deliveries, a folder of part files each: the last is late, in part copies of the first.
DELIVERIES = ("day(event_time) BETWEEN 11 AND 20", "day(event_time) > 20", "day(event_time) <= 12")


# Four, the latest days first: the last two bring copies of all before them.
LATE_DELIVERIES = ("day(event_time) > 20", "day(event_time) <= 10", "day(event_time) > 5", "true")


def _each_delivery(spark, d, start, deliveries=DELIVERIES) -> None:
    """Drain each delivery when it has come, however many files it has: one micro-batch each. ``start`` makes a query of the folders."""
    folder = scratch_path(spark, "deliveries")
    for number, rows in enumerate(deliveries):
        _part(spark, d, f"{folder}/{number}", F.expr(rows))
        streaming.run_available(start(f"{folder}/*"))


def processed_files(spark, d):
    """Deliveries and rows of each micro-batch: files from the checkpoint's log, rows from the sink. The parts a delivery was written in count as one."""
    target, checkpoint = scratch_path(spark, "sink"), scratch_path(spark, "stream")

    def start(folders):
        return streaming.start_append(to_bronze(streaming.read_event_stream(spark, folders)), target, checkpoint)

    _each_delivery(spark, d, start)
    log = history.processed_files(spark, checkpoint)
    name = lambda c: F.regexp_extract(c, "[^/]+/[^/]+$", 0)
    per_file = tables.read_table(spark, target).groupBy(name("source_file").alias("file")).agg(F.count("*").alias("n"))
    joined = log.join(per_file, name("path") == F.col("file"), "left")
    delivery = F.regexp_extract("path", "([^/]+)/[^/]+$", 1)
    return joined.groupBy("batch_id", "committed").agg(F.count_distinct(delivery).alias("files"), F.sum("n").alias("input_rows"))


def stream_progress(spark, d):
    """The same from the progress a listener keeps."""
    kept, query_name = scratch_path(spark, "progress"), scratch_path(spark, "q").rsplit("/", 1)[1]
    target, checkpoint = scratch_path(spark, "sink"), scratch_path(spark, "stream")

    def start(folders):
        rows = to_bronze(streaming.read_event_stream(spark, folders))
        return streaming.start_append(rows, target, checkpoint, name=query_name)

    listener = history.ProgressTable(spark, kept, (query_name,)).attach()
    try:
        _each_delivery(spark, d, start)
        listener.wait(len(DELIVERIES), 60)
    finally:
        listener.detach()
    return listener.read().filter("input_rows > 0").select("batch_id", "input_rows")


def stream_late_rows(spark, d):
    """Late events in a table of their own; each event in one of the two."""
    target, late, checkpoint = (scratch_path(spark, n) for n in ("silver", "late", "stream"))

    def start(folders):
        events = streaming.silver_stream(to_bronze(streaming.read_event_stream(spark, folders)), audit=False)
        return set_aside.insert_or_set_aside(events, target, late, checkpoint, "1 day")

    _each_delivery(spark, d, start)
    on_time = tables.read_table(spark, target).withColumn("is_late", F.lit(False))
    aside = tables.read_table(spark, late).withColumn("is_late", F.col("late_by_seconds") > 86_400)
    return plain(on_time.unionByName(aside.drop("late_by_seconds")))


def stream_new_column(spark, d):
    """A column that a later file brings: the ledger widens the schema, the restarted query takes it in."""
    folder, target, checkpoint = (scratch_path(spark, n) for n in ("widening", "sink", "stream"))
    ledger = SchemaLedger(spark, checkpoint)
    for rows, columns in (
        ("day(event_time) <= 15", {}),
        ("day(event_time) > 15", {"coupon": F.concat(F.lit("c"), (F.col("user_id") % 10).cast("string"))}),
    ):
        _part(spark, d, folder, F.expr(rows), **columns)
        stream = to_bronze(ledger.read_stream(folder))
        streaming.run_available(streaming.start_append(stream, target, checkpoint))
    return plain(tables.read_table(spark, target, merge_schema=True))


def secured_views(spark, d):
    """What an analyst, another one, an administrator and a stranger see through SQL, the administrator as an engineer."""
    views.act_as(spark, "nobody")
    views.create_views(spark, access_map(spark, GRANTS), customers(spark, d), products(spark, d), clean(spark, d))
    path = scratch_path(spark, "seen")
    for user, groups in ((SEGMENT_USER, ["data-analysts"]), ("analyst2@company.com", []), ("admin@company.com", ["data-engineers"]), ("x' OR true", [])):
        views.act_as(spark, user, groups)
        name = "'" + user.replace("'", "\\'") + "'"
        spark.sql(f"""
            SELECT {name} AS user_name, 'segment' AS part, customer_segment AS value, count(*) AS n
            FROM customer_metrics_secured GROUP BY 3
            UNION ALL SELECT {name}, 'category', category_l1, count(*) FROM product_performance_secured GROUP BY 3
            UNION ALL SELECT {name}, 'users', 'shown', count(user_id) FROM customer_metrics_masked
            UNION ALL SELECT {name}, 'rows', 'no_pii', count(*) FROM customer_metrics_no_pii
            UNION ALL SELECT {name}, 'price', CASE WHEN price LIKE '$%' THEN price ELSE 'clear' END, count(*)
            FROM events_cleaned_masked GROUP BY 3
        """).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def batch_load(spark, d):
    """Files to gold through every table; the funnel read back at the end."""
    at = run_batch(spark, csv_folder(spark, d), scratch_path(spark, "lake"), AS_OF)
    return plain(tables.read_table(spark, at["conversion_funnel"]))


def _part(spark, d, folder, rows, **columns):
    """The CSV rows that meet a condition as further files of a folder, one a task."""
    raw = to_bronze(read_events_csv(spark, csv_folder(spark, d)).withColumn("text_time", F.col("event_time")))
    # The files hold times in the form they are to have.
    out = raw.filter(rows).withColumn("event_time", F.col("text_time")).select(*RAW_SCHEMA.names).withColumns(columns)
    out.write.mode("append").option("header", True).csv(folder)


def lake(spark, d):
    """Two deliveries into a lake, the second mostly of earlier days, with copies of the first."""
    key = (spark.sparkContext.applicationId, d + tables.stamp(spark, d), "lake")
    if key not in _made or not tables.exists(spark, _made[key]):
        root = scratch_path(spark, "lake")
        for rows in ("day(event_time) > 12", "day(event_time) <= 15 OR user_id % 5 = 0"):
            folder = scratch_path(spark, "delivery")
            _part(spark, d, folder, F.expr(rows))
            run_batch(spark, folder, root, AS_OF, buckets=4)
        _made[key] = root
    return _made[key]


def _from_lake(name) -> Query:
    return lambda spark, d: plain(tables.read_table(spark, f"{lake(spark, d)}/{name}")).drop(
        "slot", "load", "quarantine_timestamp", "metric_timestamp"
    )


def weekly_audience(spark, d):
    return period_audience(spark, lake(spark, d), audience.week_of())


def monthly_audience(spark, d):
    return period_audience(spark, lake(spark, d), audience.month_of())


def sketched_audience(spark, d):
    """Sketches of the stored days beside the exact figures: within four standard errors."""
    exact = weekly_audience(spark, d)
    about = period_audience(spark, lake(spark, d), audience.week_of(), exact=False)
    near = [
        (F.abs(about[n] - exact[n]) <= exact[n] * (4 * audience.SKETCH_ERROR)).alias(f"{n}_near") for n in audience.WHOLE
    ]
    return exact.join(about, "period").select("period", *near)


def catalog_tables(spark, d):
    """What the catalog has to say of the lake's tables: comments, properties, statistics."""
    root = lake(spark, d)
    database = "lake_" + hashlib.sha256(root.encode()).hexdigest()[:8]
    at = {name: f"{root}/{name}" for name in TABLES}
    rows = []
    for name in register_tables(spark, at, database):
        facts = catalog.properties(spark, name)
        said = {f.name: f.metadata.get("comment") for f in spark.table(name).schema}
        count = catalog.counted_rows(spark, name)
        rows.append((name.split(".")[1], catalog.details(spark, name).get("Comment"), facts.get("layer"), count, said.get("price")))
    return spark.createDataFrame(rows, "table_name string, comment string, layer string, counted_rows bigint, price_comment string")


def load_lineage(spark, d):
    """Rows by file of origin, and whether the load stamps lie within the load."""
    folder = scratch_path(spark, "lineage")
    for i in range(3):
        _part(spark, d, f"{folder}/{'abc'[i]}", F.expr(f"user_id % 3 = {i}"))
    started = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None) - datetime.timedelta(minutes=1)
    rows = to_bronze(read_events_csv(spark, f"{folder}/*"))
    path = scratch_path(spark, "loaded")
    silver.to_silver(rows).write.parquet(path)
    inside = lambda c: F.min(F.col(c).between(F.lit(started).cast("timestamp"), F.current_timestamp()))
    origin = F.regexp_extract("source_file", "/([abc])/[^/]+[.]csv$", 1).alias("origin")
    return spark.read.parquet(path).groupBy(origin).agg(
        F.count("*").alias("n"), inside("ingestion_timestamp").alias("loaded_now"), inside("processed_timestamp").alias("processed_now")
    )


def csv_only(spark, d):
    """A folder that also holds a file of another kind: its rows are not read."""
    folder = scratch_path(spark, "mixed")
    _part(spark, d, folder, F.expr("user_id % 2 = 0"))
    spark.range(50).select(F.lit("2024-01-01 00:00:00 UTC,view,1,1,a,b,1.0,1,s")).coalesce(1).write.mode("append").text(folder)
    return read_events_csv(spark, folder).groupBy("event_type").agg(F.count("*").alias("n"))


def malformed_records(spark, d):
    """Lines with a price that is no number: told apart from lines without one, and kept."""
    folder = scratch_path(spark, "broken")
    _part(spark, d, folder, F.expr("user_id % 7 <> 0"))
    _part(spark, d, folder, F.expr("user_id % 7 = 0"), price=F.concat(F.lit("x"), F.col("price").cast("string")))
    kept = silver.to_quarantine(to_bronze(read_events_csv(spark, folder, keep_malformed=True)))
    return kept.groupBy("quarantine_reason").agg(
        F.count("*").alias("n"), F.count_if(F.col(MALFORMED).contains(",x")).alias("with_line")
    )


def session_format(spark, d):
    """Half of the sessions get an id of the published form."""
    made = F.when(F.col("user_id") % 2 == 0, F.md5(F.col("user_session").cast("binary"))).otherwise(F.col("user_session"))
    rows = clean(spark, d).withColumn("user_session", made)
    return rows.groupBy(quality.is_valid(session_format=True).alias("valid")).agg(F.count("*").alias("n"))


def column_check(spark, d):
    """Columns of given tables beside those of the events."""
    found = []
    for name, table in (("silver", clean(spark, d)), ("raw", read_events_csv(spark, csv_folder(spark, d))), ("events", read_parquet(spark, d, "events"))):
        complete, missing, extra = check_columns(table, RAW_SCHEMA.names)
        found.append((name, complete, ",".join(missing), len(extra)))
    return spark.createDataFrame(found, "table_name string, complete boolean, missing string, extra int")


def external_table(spark, d):
    """Files under a catalog name, with the partitions their folders name, and counted by its statistics."""
    path = scratch_path(spark, "external")
    tables.write_full(clean(spark, d), path, ["event_date"], staged=False)
    name = "ext_" + hashlib.sha256(path.encode()).hexdigest()[:10]
    tables.register_external(spark, name, path)
    maintenance.analyze(spark, name, ["product_id"])
    counted = catalog.counted_rows(spark, name)
    top = int(catalog.column_statistics(spark, name, "product_id")["max"])
    out = spark.sql(f"SELECT event_date, count(*) AS n FROM {name} WHERE event_date >= DATE'2024-01-10' GROUP BY event_date")
    return out.select("*", F.lit(counted).cast("bigint").alias("counted"), F.lit(top).cast("bigint").alias("greatest_product"))


def enrich_bucketed(spark, d):
    """Events and products bucketed alike: joined where they lie."""
    tag = hashlib.sha256(f"{d}{scratch_path(spark, 'b')}".encode()).hexdigest()[:10]
    rows = clean(spark, d).select("event_id", "product_id", "event_type", "price")
    left = catalog.write_bucketed(rows, f"events_by_product_{tag}", "product_id", 8)
    right = catalog.write_bucketed(dims.products_dim(clean(spark, d)), f"products_{tag}", "product_id", 8)
    return dims.enrich(left, right, "product_id", ["brand", "category_l1", "price"])


# Audited writes

def _nulled(spark, d):
    """Bronze with gaps in the columns that the critical rules name."""
    gap = lambda n, k, c: F.when(F.col("user_id") % n != k, F.col(c)).alias(c)
    rows = bronze(spark, d)
    made = {"event_time": gap(10, 3, "event_time"), "product_id": gap(7, 2, "product_id"), "user_id": gap(11, 5, "user_id")}
    return rows.select(*[made.get(c, F.col(c)) for c in rows.columns])


def critical_rules(spark, d):
    return quality.expectation_counts(_nulled(spark, d), quality.CRITICAL)


def audited_load(spark, d):
    """Counts taken in the pass that wrote the table."""
    audit = publish.publish(bronze(spark, d), scratch_path(spark, "audited"), quality.EXPECTATIONS, "drop")
    return audit.report(spark)


def audited_rows(spark, d):
    """What that pass published, partitioned, in two parts."""
    path, rows = scratch_path(spark, "audited"), silver.standardize(bronze(spark, d))
    for part, mode in (("user_id % 2 = 0", "replace"), ("user_id % 2 <> 0 OR user_id IS NULL", "append")):
        publish.publish(rows.filter(part), path, quality.EXPECTATIONS, "drop", ["event_type"], mode)
    return plain(tables.read_table(spark, path))


def expectation_fail(spark, d):
    """A load that breaks a rule leaves the table as it was."""
    path = scratch_path(spark, "guarded")
    publish.publish(quality.filter_valid(bronze(spark, d)), path, action="fail")
    broken = 0
    try:
        publish.publish(bronze(spark, d), path, action={"valid_price": "warn", "valid_user_id": "fail", "valid_event_type": "fail"})
    except publish.ExpectationsFailed as refused:
        broken = len(refused.audit.broken)
    return plain(tables.read_table(spark, path)).withColumn("broken_rules", F.lit(broken))


# Profile and upkeep

def profile_csv(spark, d):
    per_file = profiling.profile_csv(spark, csv_folder(spark, d)).drop("source_file")
    return per_file.agg(*[F.sum(c).alias(c) for c in per_file.columns])


def null_profile(spark, d):
    return profiling.null_counts(bronze(spark, d))


def compact(spark, d):
    path = scratch_path(spark, "compact")
    tables.append(clean(spark, d).repartition(16), path)
    maintenance.compact(spark, path)
    return plain(tables.read_table(spark, path))


def compact_partitioned(spark, d):
    """A partitioned table stays partitioned: its rows, and the days its folders name."""
    path = scratch_path(spark, "compact")
    tables.write_full(clean(spark, d).repartition(4), path, ["event_date"], staged=False)
    maintenance.compact(spark, path)
    kept = spark.createDataFrame([(v,) for v in tables.partition_values(spark, path, "event_date")], "day string")
    return plain(tables.read_table(spark, path)).join(kept, F.col("event_date").cast("string") == F.col("day")).drop("day")


def upsert_null_partition(spark, d):
    """Two deliveries into a table with a partition of NULL: the second leaves the first's rows there."""
    target = scratch_path(spark, "nulls")
    rows = clean(spark, d).select(
        "event_id", "event_time", "user_id", F.expr("CASE WHEN user_id % 3 <> 0 THEN event_type END").alias("kind")
    )
    for part in (F.col("user_id") % 2 == 0, F.col("user_id") % 5 != 4):
        upsert.upsert_table(rows.filter(part), target, partition_column="kind", order=("event_time",))
    return tables.read_table(spark, target).groupBy("kind").agg(F.count("*").alias("n"))


def cluster(spark, d):
    path = scratch_path(spark, "cluster")
    rows = maintenance.cluster(clean(spark, d), ["user_id", "product_id"], curve="morton")
    rows.write.parquet(path)
    return plain(tables.read_table(spark, path))


def retention(spark, d):
    path = scratch_path(spark, "retention")
    tables.write_full(clean(spark, d), path, ["event_date"])
    maintenance.apply_retention(spark, path, 14, datetime.date.fromisoformat(AS_OF))
    return plain(tables.read_table(spark, path))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        bronze_parse, csv_roundtrip, silver_clean, silver_dedup, event_id, category_levels, date_parts,
        filter_valid, orders_filter_valid, quarantine, quarantine_reasons, expectation_counts,
        expectations_apply, expectations_warn, quality_report, completeness_flags, validity_flags,
        duplicate_count, duplicate_rows, insert_new, upsert_rows, upsert_table, upsert_null_partition,
        customer_agg, customer_metrics, customer_core, customer_latest_day,
        product_agg, product_derived, product_performance, product_rank_scalable, product_core,
        daily_agg, daily_sales_summary, daily_calendar_frames, daily_core,
        funnel_agg, funnel_expand, conversion_funnel, funnel_core, data_quality_metrics,
        orders_customers, orders_products, orders_daily, orders_funnel,
        products_dim, users_dim, enrich,
        events_between, user_journey, purchases_in_category,
        mask_functions, secure_by_segment, secure_by_category, secure_as_admin, no_pii, mask_customer,
        mask_events, mask_tagged, access_coverage, audit_daily,
        stream_bronze, stream_silver, stream_late, stream_quarantine, stream_upsert, processed_files,
        batch_load, weekly_audience, monthly_audience, sketched_audience, catalog_tables,
        stream_progress, stream_late_rows, stream_new_column, secured_views, load_lineage, csv_only,
        malformed_records, session_format, column_check, external_table, enrich_bucketed,
        critical_rules, audited_load, audited_rows, expectation_fail, orders_customer_metrics,
        mask_events_engineer, mask_customer_engineer,
        profile_csv, null_profile, compact, compact_partitioned, cluster, retention,
    )
}
QUERIES |= {
    "batch_load_twice": _from_lake("customer_metrics"),
    "batch_load_products": _from_lake("product_performance"),
    "batch_load_days": _from_lake("daily_sales_summary"),
    "batch_load_funnel": _from_lake("conversion_funnel"),
    "batch_load_quarantine": _from_lake("events_quarantine"),
    "batch_load_quality": _from_lake("data_quality_metrics"),
    "bronze_type_distribution": _on(bronze, reports.event_type_distribution),
    "event_type_distribution": _on(clean, reports.event_type_distribution),
    "date_range": _on(bronze, reports.date_range),
    "top_categories": _on(clean, reports.top_categories),
    "top_brands": _on(clean, reports.top_brands),
    "default_fill_counts": _on(clean, reports.default_fill_counts),
    "hourly_pattern": _on(clean, reports.hourly_pattern),
    "top_customers": _on(customers, reports.top_customers),
    "segment_distribution": _on(customers, reports.segment_distribution),
    "customer_summary": _on(customers, reports.customer_summary),
    "top_products": _on(products, reports.top_products),
    "revenue_by_category": _on(products, reports.revenue_by_category),
    "revenue_by_brand": _on(products, reports.revenue_by_brand),
    "product_summary": _on(products, reports.product_summary),
    "revenue_trend": _on(days, reports.revenue_trend),
    "day_of_week": _on(days, reports.day_of_week),
    "daily_summary": _on(days, reports.daily_summary),
    "latest_funnel": _on(stages, reports.latest_funnel),
    "overall_funnel": _on(stages, reports.overall_funnel),
    "funnel_by_category": _on(stages, reports.funnel_by_category),
    "cart_abandonment": _on(stages, reports.cart_abandonment),
    "funnel_summary": _on(stages, reports.funnel_summary),
}


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    run.__name__, run.__doc__ = getattr(query, "__name__", "query"), query.__doc__
    return run


QUERIES = {name: _configured(query) for name, query in QUERIES.items()}
