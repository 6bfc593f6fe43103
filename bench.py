"""Headline-query benchmark.

Runs the named queries over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.
Each query is executed in full with a ``noop`` write (no rows reach the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from velolake.plans.registry import all_queries  # noqa: E402
from velolake.session import build_session  # noqa: E402

HEADLINE = [
    "silver_rides_valid",
    "silver_telemetry_quarantine",
    "quarantine_reason_counts",
    "fact_rides",
    "dim_time_hourly",
    "mart_revenue",
    "mart_fleet_health",
    "mart_revenue_minutely",
    "mart_revenue_default",
    "mart_fleet_health_default",
    "validation_report",
    "kpi_fleet",
    "last10_revenue",
    "stream_end_to_end",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="velolake-bench", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": "8g"})
    qs = all_queries()
    # warm-up: JIT and file listing, not timed
    qs["fact_overview"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, errors = {}, {}
    for name in names:
        t0 = time.perf_counter()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # report and go on: one failure must not hide the others
            times[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:300]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
