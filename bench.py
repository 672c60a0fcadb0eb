"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR   folder with the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     cores (default all)
    BENCH_QUERIES  comma-separated subset
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

from checks.catalog import queries

HEADLINE = (
    "src_tsv_transactions", "src_event_jsonl", "src_openbanking_transactions", "src_complaints", "src_camt",
    "stg_scan_batch", "parse_scalars", "surrogate_ids", "resolve_crm_clients", "client_source_map",
    "load_accounts", "load_transactions", "load_digital_events", "load_appeals", "fold_upsert",
    "client_metrics", "segment_classify", "segment_history", "profile_export", "mart_segment_metrics",
    "mart_client_activity_daily", "mart_financial_activity_daily", "mart_digital_activity_daily",
    "replace_date_range", "q_client_segmentation", "q_client_activity_daily",
)


def main() -> int:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    known["active_products"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in names:
        started = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "bank_warehouse_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
