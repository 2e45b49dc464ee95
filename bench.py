"""Benchmark the headline queries.

Runs each query fully (``write.format('noop')`` executes every stage without
collecting to the driver) on ``local[$BENCH_CPUS]`` against
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

``BENCH_QUERIES=all`` times every registered query instead of the headline set.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "peak_premium",            # flagship: monthly totals -> seasonal premium
    "clean_dedupe",            # keep-first dedupe on the fact key
    "outlier_flag",            # per-product p99 + join back
    "expectation_suite",       # 20 checks, one aggregate
    "monthly_export_view",     # star view
    "yoy_top15",               # top-k + semi join + densified YoY
    "opportunity_total",       # benchmark panel -> opportunity
    "risk_bands",              # five signals, scaling, percentile bands
    "segment_rules",           # per-key features + rule labels
    "seasonal_decompose",      # windows over the monthly panel
    "seasonal_naive_cv",       # rolling-origin folds
    "arx_forecast",            # Hannan-Rissanen fits of all series
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tradelens.plans.registry import load_all
    from tradelens.session import get_session

    ckpt = tempfile.mkdtemp(prefix="tradelens-bench-ckpt-")
    spark = get_session(f"local[{cpus}]", "tradelens-bench", shuffle_partitions=2 * cpus,
                        extra={"spark.driver.memory": "16g", "spark.checkpoint.dir": ckpt,
                               "spark.sql.files.maxPartitionBytes": str(64 << 20)})
    spark.sparkContext.setLogLevel("ERROR")
    reg = load_all()
    names = list(reg) if os.environ.get("BENCH_QUERIES") == "all" else HEADLINE

    # warm-up (JIT, file listing caches): not timed
    reg["monthly_total"].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        reg[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
