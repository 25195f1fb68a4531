"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}.
Each query is executed to completion with the ``noop`` sink (every row is
produced, nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "masked_anomaly_report", "climatology", "anomalies", "anomaly_window", "validate_grid",
    "missing_dates", "histogram", "robust_bounds", "regrid_nearest", "bilinear_points", "coarsen_mean",
    "random_points_per_date", "sample_obs", "build_tasks", "predict_grid", "gap_fill",
    "weighted_scores", "preprocess", "prepare_ice", "acquisition_mean", "greedy_place",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE

    from lakecube.registry import QUERIES
    from lakecube.session import get_session

    spark = get_session(f"local[{cpus}]", app="lakecube-bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", 2 * cpus)))
    # untimed warm-up: JVM class loading and code generation, on a table no query reads
    spark.read.parquet(os.path.join(sf_dir, "region.parquet")).groupBy("r_name").count().collect()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))


if __name__ == "__main__":
    main()
