"""Wall seconds of the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "clean_loans", "fact_loans", "industry_overview", "bank_comparison", "describe_numeric", "fence_percentages",
    "correlation_pairs", "histogram", "kernel_density", "minute_density", "hotspots", "daily_kmeans", "stratified_plan",
    "balanced_plan", "random_oversample", "target_encode_cross_fitted", "recipe_features", "classification_metrics",
    "roc_curve", "regression_metrics", "cv_metrics_by_task", "frequent_itemsets", "association_rules", "knn_join", "smote",
    "near_miss", "gaussian_nb", "linear_regression", "partial_dependence", "permutation_importance", "decision_tree",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tallyfold.catalog import QUERIES
    from tallyfold.session import get_spark
    spark = get_spark("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "20g")})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["count_by_two_keys"](spark, folder).collect()  # start-up is not a query's cost
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)
    sf = folder.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
