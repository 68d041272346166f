"""Time the headline queries and print one JSON line.

Each query runs once to warm up and three times measured; the median counts.  Results are computed in
full and written to Spark's no-op sink.  BENCH_SF_DIR names the data folder, BENCH_CPUS the cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from usertide.catalog import QUERIES  # noqa: E402
from usertide.session import scratch  # noqa: E402

HEADLINE = (
    "clean_users", "clean_events", "clean_events_report", "quality_audit", "relational_audit", "latency_summary",
    "latency_histogram", "user_features", "behaviour_features", "order_user_features", "order_retention_cohorts",
    "user_retention_metrics", "order_retention_metrics", "roc_auc", "roc_points", "pr_points", "pick_threshold",
    "threshold_sweep", "risk_segments", "segment_summary", "churn_by_country", "order_stratified_split",
    "nearest_centroid", "cluster_boxplots", "describe_order_totals", "logistic_coefficients", "score_users", "isotonic_scores",
    "kmeans_choices",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("usertide-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            with scratch(spark):
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
