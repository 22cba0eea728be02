"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is planned and fully executed (rows written to a no-op sink), timed warm: one
untimed warm-up run of the whole set first, then the median of $BENCH_REPS runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vigil.plans.catalog import QUERIES  # noqa: E402
from vigil.session import get_session  # noqa: E402

HEADLINE = [
    "first_block", "cohort_demographics", "state_blocks", "window_features_wide", "ratio_at_same_time",
    "range_filtered_worst", "asof_weight", "dose_converted", "dose_summary", "score_ladder", "roc_points",
    "auc_brier", "topn_sweep", "calibration_equal_width", "fairness", "settings_summary", "initial_mode_table",
    "organ_score", "organ_score_distribution", "describe_features", "table1", "bootstrap_ci",
]


def run(spark, name, d):
    t0 = time.perf_counter()
    QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = [n for n in HEADLINE if n in QUERIES]
    # Sized for a local run at small scale: one shuffle partition per core, and a small
    # minimum partition size so adaptive coalescing keeps the cores busy on post-shuffle
    # stages of a few MB (at cluster scale partitions are far above either limit).
    spark = get_session(f"local[{cpus}]", int(cpus), app="vigil-bench",
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g"),
                               "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"})
    for n in names:
        run(spark, n, d)
    times = {}
    for n in names:
        times[n] = round(statistics.median(run(spark, n, d) for _ in range(reps)), 3)
    sf = os.path.basename(d.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_median_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus), "reps": reps}))


if __name__ == "__main__":
    main()
