"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   folder of the test tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local threads (default 8)

``silver_*`` entries are the cleaning stage, written as a table; gold queries read it, as in
the pipeline. One small load warms up the session; after that each figure is one
complete run of a query, planning and code generation included.
"""

from __future__ import annotations

import json
import os
import sys
import time

from shopstream import get_spark

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))

HEADLINE = (
    "bronze_parse filter_valid quarantine quality_report duplicate_count duplicate_rows insert_new "
    "upsert_rows customer_metrics product_performance product_rank_scalable daily_sales_summary "
    "conversion_funnel funnel_expand customer_core product_core daily_core funnel_core "
    "data_quality_metrics enrich segment_distribution revenue_by_category day_of_week overall_funnel "
    "cart_abandonment secure_by_segment mask_events orders_customers orders_products orders_daily "
    "orders_funnel csv_roundtrip stream_silver"
).split()


def main() -> None:
    spark = get_spark(
        "bench",
        f"local[{CPUS}]",
        CPUS,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    from workload import queries as work

    times: dict[str, float] = {}

    def clock(name, run):
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    warm_up = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_up):
        work.clean(spark, warm_up)
    clock("silver_build", lambda: work.clean(spark, SF_DIR))
    clock("silver_orders", lambda: work.orders_clean(spark, SF_DIR))
    for name in sys.argv[1:] or HEADLINE:
        query = work.QUERIES[name]
        clock(name, lambda: query(spark, SF_DIR).write.format("noop").mode("overwrite").save())
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
