"""Headline queries, timed; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import time

from modlake.checks import load
from modlake.session import PARTITIONS, local_session

HEADLINE = (
    "dense_features", "eda_class_means", "eda_class_histograms_lines",
    "eda_correlation_matrix_lines", "eda_top_features_lines", "roc_auc_lines",
    "calibration_lines", "error_score_histogram_lines", "talk_comments", "scored_comments",
    "article_rollup", "toxicity_trend", "threshold_reevaluation", "queue_by_toxicity",
    "sentiment_scores",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench", **{PARTITIONS: cpus})
    queries = load().QUERIES
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # start-up is not measured
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
