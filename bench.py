"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query runs once to
warm up and then once for its time, in full, into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import time

from orderpulse.plans.catalog import QUERIES
from orderpulse.session import build_session

HEADLINE = (
    "window_totals_1m", "window_totals_5m", "window_totals_sliding", "user_window_counts_1m",
    "user_running_stats", "user_running_stats_basic", "user_order_stats",
    "user_order_profile", "parse_order_events", "cast_with_defaults", "latest_per_user",
    "top_users", "top_vip_users", "analytics_summary", "recent_windows",
    "reject_duplicate_email", "order_lines", "orders_by_region", "top_products",
    "counter_rate_by_pod", "gauge_sum_by_pod", "usage_vs_limit", "request_summary",
    "check_rate", "window_anomalies", "file_envelope", "stream_window_totals_1m",
    "stream_user_window_counts_1m", "stream_user_running_stats",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        times[name] = round(run(spark, name, sf_dir), 3)
    spark.stop()
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir).removeprefix("sf")}))


if __name__ == "__main__":
    main()
