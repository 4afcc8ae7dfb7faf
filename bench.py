"""Headline queries on one machine; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the number of threads. Each query runs once to warm up and is then
timed; its result goes to the ``noop`` sink, so every row is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskweave.session import build_session, clean_up  # noqa: E402
from riskweave.workload import all_queries  # noqa: E402

HEADLINE = (
    "drift_report",
    "ks_statistic",
    "psi_categorical",
    "chi_square_homog",
    "roc_auc",
    "threshold_sweep",
    "sliced_metrics",
    "preprocess_fit_apply",
    "etl_generic",
    "clip_iqr",
    "histogram_value",
    "duplicate_lines",
    "corr_matrix",
    "churn_by_category",
    "split_stratified",
    "poly_interactions",
    "batch_score",
    "top_factors",
    "latest_runs",
    "daily_psi_batch",
    "knn_classify",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = build_session(f"local[{cpus}]", int(cpus), "riskweave-bench")
    queries = all_queries()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for attempt in range(repeats + 1):
            started = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            if attempt and (best is None or took < best):
                best = took
        seconds[name] = round(best, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    clean_up(spark)
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
