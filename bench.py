"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Each query is forced to completion with the ``noop`` sink, which runs the
whole plan (every row produced) without collecting results to the driver.

The published reference figures are bytes scanned by two exploration
queries on an unpartitioned, a day-partitioned and a partitioned + clustered
written once (``layout_setup_sec``, not part of the total), the queries are
timed like the others, and the bytes and rows each query's scans read are
taken from Spark's event log, written to a fresh scratch folder.  Bytes
include per-file overhead (footers), which dominates when a day holds a
few rows, as in the small test tables; rows scanned is the part that scales
like the warehouse's billed bytes.
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "monthly_zone_revenue",
    "fct_trips",
    "trips_dedup",
    "dim_vendors",
    "interval_staging",
    "interval_daily_report",
    "top_payment_types",
    "dedup_composite",
    "by_vendor",
    "by_year_month",
    "distinct_days",
    "count_range_vendor",
    "check_not_null",
    "check_relationships",
    "merge_upsert",
    "delete_insert",
    "ml_feature_info",
    "ml_predict_categorical",
    # persisted flows: incremental fact (two runs), interval pipeline (three runs)
    "incremental_fact",
    "interval_pipeline_runs",
]

# (unpartitioned, partitioned) and (partitioned, partitioned + clustered)
LAYOUT = [
    "distinct_vendors_flat",
    "distinct_vendors_by_day",
    "count_range_vendor_by_day",
    "count_range_vendor_clustered",
    "distinct_vendors_by_month",
    "count_range_vendor_by_month",
    "count_range_vendor_month_clustered",
    "count_range_vendor_month_ranges",
]

LAYOUT_TABLES = {
    "distinct_vendors_flat": "flat",
    "distinct_vendors_by_day": "by_day",
    "count_range_vendor_by_day": "by_day",
    "count_range_vendor_clustered": "by_day_vendor",
    "distinct_vendors_by_month": "by_month",
    "count_range_vendor_by_month": "by_month_groups",
    "count_range_vendor_month_clustered": "by_month_vendor",
    "count_range_vendor_month_ranges": "by_month_ranges",
}

BASELINE_BYTES = {
    "distinct_vendors_flat": 1.6e9,
    "distinct_vendors_by_day": 106e6,
    "count_range_vendor_by_day": 1.1e9,
    "count_range_vendor_clustered": 864.5e6,
}


def input_by_group(log_dir: str) -> dict[str, dict[str, int]]:
    """Sum the input bytes and records of every task, per job group, from
    the event log."""
    stage_group: dict[int, str] = {}
    out: dict[str, dict[str, int]] = defaultdict(lambda: {"bytes": 0, "rows": 0})
    paths = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(p) and not p.endswith(".crc"))
    for path in paths:
        with open(path) as fh:
            for line in fh:
                if not line.startswith("{"):
                    continue
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    metrics = ev.get("Task Metrics") or {}
                    if group:
                        read = metrics.get("Input Metrics") or {}
                        out[group]["bytes"] += read.get("Bytes Read", 0)
                        out[group]["rows"] += read.get("Records Read", 0)
    return dict(out)


def ratio(a, b):
    return round(a / b, 4) if b else None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE + LAYOUT

    from meterline.plans.catalog import QUERIES, trips_layout
    from meterline.session import get_session

    log_dir = tempfile.mkdtemp(prefix="meterline-bench-events-")
    spark = get_session(master=f"local[{cpus}]", app="meterline-bench",
                        shuffle_partitions=max(8, 2 * int(cpus)),
                        extra_conf={"spark.eventLog.enabled": "true",
                                    "spark.eventLog.dir": log_dir,
                                    "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    # warm the JVM (class loading, codegen caches) outside the timings
    QUERIES["distinct_days"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    setup = 0.0
    if any(n in LAYOUT for n in only):
        t0 = time.perf_counter()
        for layout in dict.fromkeys(LAYOUT_TABLES[n] for n in only if n in LAYOUT):
            trips_layout(spark, sf_dir, layout)
        setup = time.perf_counter() - t0

    times = {}
    for name in only:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    # bytes are counted in runs of their own: what other threads read
    # (vectored reads) is not in a task's byte count
    spark.conf.set("parquet.hadoop.vectored.io.enabled", "false")
    for name in (n for n in only if n in LAYOUT):
        sc.setJobGroup(name, name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    sc.setJobGroup("", "")
    spark.stop()  # flushes the event log

    read = input_by_group(log_dir)
    scanned = {n: read.get(n, {"bytes": 0, "rows": 0}) for n in only if n in LAYOUT}

    def layout_ratio(num: str, den: str) -> dict:
        a, b = scanned.get(num), scanned.get(den)
        if not a or not b:
            return {}
        return {"bytes": ratio(a["bytes"], b["bytes"]), "rows": ratio(a["rows"], b["rows"])}

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "layout_setup_sec": round(setup, 3),
        "scanned": scanned,
        "layout_ratios": {
            "by_day_vs_flat": layout_ratio("distinct_vendors_by_day", "distinct_vendors_flat"),
            "clustered_vs_by_day": layout_ratio("count_range_vendor_clustered",
                                                "count_range_vendor_by_day"),
            "by_month_vs_flat": layout_ratio("distinct_vendors_by_month", "distinct_vendors_flat"),
            "clustered_vs_by_month": layout_ratio("count_range_vendor_month_clustered",
                                                  "count_range_vendor_by_month"),
            "ranges_vs_by_month": layout_ratio("count_range_vendor_month_ranges", "count_range_vendor_by_month"),
        },
        "baseline_ratios": {
            "by_day_vs_flat": ratio(BASELINE_BYTES["distinct_vendors_by_day"],
                                    BASELINE_BYTES["distinct_vendors_flat"]),
            "clustered_vs_by_day": ratio(BASELINE_BYTES["count_range_vendor_clustered"],
                                         BASELINE_BYTES["count_range_vendor_by_day"]),
        },
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
