"""Time the named queries and print one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) on local[BENCH_CPUS]. Every query runs once
to warm up and BENCH_RUNS times for the record; its time is the median. Rows are computed in
full and thrown away. ``empty_query`` is the time of a query without input, which every other
time contains.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from odsflow.registry import QUERIES
from odsflow.session import local_session

#: Reported queries, marts, recent-activity queries, and one or more of every other kind.
HEADLINE = (
    "cs1_totals", "cs2_by_event_type", "cs3_sources", "cs4_window_read", "cs5_session_read",
    "cdc1_orders_by_status", "cdc2_revenue_by_category", "cdc3_demographics", "cdc4_orders_by_demographic",
    "cdc5_stock_by_centre", "window_agg", "sessions", "sales_flat", "sales_hourly", "product_performance",
    "inventory_details", "q1_funnel", "q2_freshness", "q3_trending", "q4_hourly_rows", "q4b_hourly_rollup",
    "lag_recent_stats", "throughput_stability", "dedup_events", "deadletter_rows", "cdc_flatten",
    "unique_key_merge", "unique_key_delete", "upsert_partial_columns", "dash_monthly_trend", "dash_top_products",
    "dash_funnel_by_category", "trip_kpis", "trips_by_hour", "speed_by_hour_daytype", "gps_points",
    "dq_rules", "dq_foreign_keys",
)


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = local_session(cores, "odsflow-bench")

    def timed(build) -> float:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        return round(statistics.median(taken[1:]), 4)

    empty = timed(lambda: spark.range(1))
    times = {name: timed(lambda name=name: QUERIES[name].run(spark, path)) for name in names}
    result = {
        "metric": "total time of headline queries, median of warm runs",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(path.rstrip("/")).removeprefix("sf"),
        "empty_query": empty,
        "cpus": cores,
        "runs": runs,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
