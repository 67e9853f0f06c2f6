"""Benchmark: headline fixture queries + the end-to-end batch scoring flow.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints ONE JSON line.  Each query runs its whole plan into the ``noop``
sink (nothing is collected); the batch flow writes real Parquet predictions.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "bin_share", "feature_prep", "validate_rows", "one_hot_scale", "quality_gate_monthly",
    "drift_check", "roc_auc", "calibrated_threshold", "latency_summary_a", "spearman",
    "latest_state", "status_change", "snapshot_gap", "request_rate", "latency_quantile",
    "dashboard_join", "alerts", "soft_vote", "model_rank", "parity_compare", "stratified_split",
    "scorecard",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from scorewell.session import get_session
    spark = get_session(master=f"local[{cpus}]", app="scorewell-bench", shuffle_partitions=max(8, 2 * cpus),
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    from scorewell.plans.registry import all_queries
    from scorewell.plans.scoring_queries import run_flow
    qs = all_queries()
    names = [n for n in HEADLINE if n in qs]
    only = os.environ.get("BENCH_ONLY")
    if only:
        names = [n for n in names if re.fullmatch(only, n)]
    times: dict[str, float] = {}
    def run(n: str) -> float:
        t0 = time.time()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.time() - t0

    # one warm-up and the median of three (of fewer where that takes over 15 s), so that rounds compare
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    for n in names:
        times[f"first.{n}"] = round(run(n), 3)
        got = [run(n)]
        while len(got) < repeat and sum(got) < 15:
            got.append(run(n))
        times[n] = round(statistics.median(got), 3)
    # beside the total: the dearest searches, and ordered metrics over many small buckets
    for n in ("weight_search", "permutation_importance"):
        if not only or re.fullmatch(only, n):
            t0 = time.time()
            qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[f"extra.{n}"] = round(time.time() - t0, 3)
    spark.conf.set("scorewell.rowsPerBucket", "5000")
    for n in ("roc_auc", "spearman", "status_change", "stratified_split"):
        if not only or re.fullmatch(only, f"{n}_buckets"):
            t0 = time.time()
            qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[f"buckets.{n}"] = round(time.time() - t0, 3)
    spark.conf.unset("scorewell.rowsPerBucket")
    if not only or re.fullmatch(only, "batch_flow"):
        out = tempfile.mkdtemp(prefix="scorewell-bench-")
        t0 = time.time()
        stages = run_flow(spark, sf_dir, out)
        times["batch_flow"] = round(time.time() - t0, 3)
        for k, v in stages.items():
            times[f"batch_flow.{k}"] = round(v, 3)
    total = round(sum(v for k, v in times.items() if "." not in k), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else None, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
