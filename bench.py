"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))  # for Python workers

from daybook.plans.catalog import QUERIES  # noqa: E402
from daybook.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "clean_job",
    "feature_job",
    "expanding_fill",
    "batch_lags",
    "upsert_history",
    "predict_job",
    "incremental_history",
    "detect_outliers",
    "fill_numeric_median",
    "forecast_metrics",
    "store_comparison",
    "error_pct_stats",
    "kde",
    "residual_acf",
    "abs_error_cdf",
    "residuals_by_quintile",
    "correlation_matrix",
    "success_rate",
    "mean_baseline",
    "baselines",
    "boosted_trees",
)


def wide_training(spark):
    """About half a million rows, every supplier a store. Yields (name, seconds)."""
    from pyspark.ml.regression import LinearRegression, RandomForestRegressor

    from daybook.ml import models, split
    from daybook.plans.features import build_features
    from daybook.session import scratch_path
    from daybook.sources import files, retail

    start = time.time()
    path = scratch_path(spark, "wide-features")
    files.sink_stage(build_features(retail.sales_panel(spark, SF_DIR)), path)
    yield "wide_feature_table", time.time() - start
    train, test = split.time_split(files.scan_stage(spark, path))
    rows = models.assemble(train).select("features", "label").persist()
    rows.count()
    for name, estimator in (
        ("wide_linear_regression", LinearRegression()),
        ("wide_random_forest_100", RandomForestRegressor(numTrees=100, maxDepth=10, seed=42)),
    ):
        start = time.time()
        estimator.fit(rows)
        yield name, time.time() - start
    rows.unpersist()


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) if CPUS.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{SF_DIR}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()  # start the JVM
    timings = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - start, 3)
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)
    if not sys.argv[1:]:
        for name, seconds in wide_training(spark):
            timings[name] = round(seconds, 3)
            print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
