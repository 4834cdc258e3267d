"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. Each query is executed in full (``noop`` sink, so
no rows travel to the driver); one warm-up pass, then the median of
``BENCH_RUNS`` timed runs per query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tierflow.plans import registry  # noqa: E402
from tierflow.session import build_session  # noqa: E402

HEADLINE = [
    "kpi_yearly",
    "kpi_monthly",
    "kpi_monthly_by_supplier",
    "yoy_delta",
    "supplier_performance_top15",
    "top_suppliers_month",
    "upsert_orders_1pct",
    "upsert_orders_10pct",
    "change_feed",
    "net_changes",
    "scd2_sound",
    "conform_location",
    "quality_duplicates",
    "csv_roundtrip",
    "stream_equals_batch",
]


def run_once(spark, name, sf_dir):
    t0 = time.perf_counter()
    df = registry.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        shuffle_partitions=int(cpus) * 2,
        conf={"spark.driver.memory": "16g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tierflow-bench-")},
    )
    names = [n for n in HEADLINE if n in registry.QUERIES]
    for n in names:  # warm-up: JIT, file listing, broadcast of small dims
        run_once(spark, n, sf_dir)
    result = {}
    for n in names:
        result[n] = round(statistics.median(run_once(spark, n, sf_dir) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(result.values()), 3),
        "unit": "sec",
        "queries": result,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
