"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

All queries run once to warm up, then each ``$BENCH_RUNS`` times (default 1); the median counts.
``$BENCH_QUERIES`` may name other queries, comma-separated, or ``all``.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from cartlake.catalog import QUERIES
from cartlake.session import build_session

HEADLINE = """
kpi_daily_region kpi_hourly_region kpi_orders_hourly kpi_ads_hourly kpi_requested_range kpi_any_grouping
kpi_heavy_value kpi_first_text metrics_collapse ads_region_inference route_topics extract_payload hmac_signature
order_enrich order_item_rollup project_payments dedupe_latest state_upsert state_merge change_feed
state_lookup_secondary abandoned_checkouts cohort_churn revenue_by_source discount_impact rebill_number
retention_curve orders_by_state dq_hourly_gaps dq_count_anomaly dq_validate_orders alerts_high_value alarm_5min
backfill_windows window_orders erase_customer bulk_snapshot stream_state_upsert stream_alarm_5min stream_dedupe
""".split()


def timed(fn) -> float:
    began = time.perf_counter()
    fn()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        run(name)
    seconds = {name: round(statistics.median(timed(lambda: run(name)) for _ in range(runs)), 3) for name in names}  # noqa: B023
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
