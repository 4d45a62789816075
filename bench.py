"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8), forcing full execution with the ``noop``
sink; after ``$BENCH_WARMUP`` (default 2) warm-up runs it reports the median
of ``$BENCH_REPS`` (default 3) runs per query and prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from supplyscope.plans.catalog import queries  # noqa: E402
from supplyscope.session import build_session  # noqa: E402

HEADLINE = [
    "forecast_ema_alerts",
    "forecast_linear_alerts",
    "clean_history",
    "history_append",
    "refresh_inventory",
    "severity_counts",
    "gauges_to_supplies",
    "ema_last",
    "step_rate",
    "classify_status",
]


def run_once(spark, fn, sf_dir: str) -> float:
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    warmup = int(os.environ.get("BENCH_WARMUP", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          app="supplyscope-bench", extra={"spark.driver.memory": "16g"})
    qs = queries()
    out = {}
    for name in names:
        fn = qs[name]
        for _ in range(warmup):                          # JIT, codegen cache, file listing
            run_once(spark, fn, sf_dir)
        out[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(reps)), 4)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "sum_of_warm_median_query_seconds", "value": round(sum(out.values()), 4),
                      "unit": "sec", "queries": out, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
