"""Time the headline queries; prints one JSON line.

Every query writes its whole result to Spark's no-op sink. A scoring query and
an ML query warm up the JVM and are not counted. Queries of a few seconds run
three times and report the median; longer ones run once.
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scorewright.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "scored_summary", "risk_bands", "calibration_bins", "threshold_metrics", "model_metrics",
    "roc_auc_by_segment", "pr_auc_by_segment", "slice_performance",
    "psi_feature_drift", "psi_prediction_drift", "stratified_split", "three_way_split_manifest",
    "median_mode_impute", "standardize", "one_hot", "validation_report", "feature_target_bind",
    "permutation_importance_scorecard", "batch_score_evaluation", "report_payload",
    "monitoring_bundle", "train_logistic", "train_boosting", "permutation_importance_model",
    "train_and_evaluate", "batch_flow",
]
LONG = 8.0  # seconds from which a query is not repeated


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("scorewright-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="scorewright-bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    def median(name: str) -> float:
        first = run(name)
        return first if first >= LONG else sorted([first, run(name), run(name)])[1]

    run("pr_auc_by_segment")
    run("prepared_features")
    seconds = {name: median(name) for name in HEADLINE}
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
