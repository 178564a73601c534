"""Time the headline queries and print one JSON line: each once unclocked, then the median of three runs."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gradeloom.plans.catalog import QUERIES  # noqa: E402
from gradeloom.session import local_session  # noqa: E402

HEADLINE = [
    "scan_activity", "cleaned_log", "prefix_features", "prefix_features_hot_groups", "latest_rows",
    "learner_summaries", "prediction_reports", "train_test_split", "oversampled", "smote_rows",
    "roc_auc", "cutoff_sweep", "candidates_on_test", "assigned_stages", "model_leaderboard",
    "forest_predictions", "batch_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), 8)
    spark.read.parquet(f"{sf_dir}/events.parquet").count()  # start the session outside the clock
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(os.path.normpath(sf_dir)),
    }))


if __name__ == "__main__":
    main()
