"""The training job: split, search, refit, reports, model and metrics rows."""

from __future__ import annotations

import time
from dataclasses import asdict

from pyspark.sql import DataFrame

from daybook.config import DEFAULT_CONFIG, EngineConfig
from daybook.ml import models, split
from daybook.sources import files
from daybook.sources.tables import Warehouse


def train_job(
    features: DataFrame,
    model_path: str,
    report_path: str | None = None,
    warehouse: Warehouse | None = None,
    config: EngineConfig = DEFAULT_CONFIG,
    settings: models.BoostSettings | None = None,
    base: models.BoostSettings = models.BoostSettings(),
) -> models.Training:
    started = time.monotonic()
    spark = features.sparkSession
    train, test = split.time_split(features, config.train_time_ratio)
    result = models.train_boosted(train, test, settings, config, base)
    models.save_model(result.model, model_path)
    metrics = result.metrics.first().asDict()
    if report_path:
        files.report_sink(result.metrics, f"{report_path}/metrics", "csv")
        files.report_sink(spark.createDataFrame([asdict(result.settings)]), f"{report_path}/best_params", "json")
        files.report_sink(
            models.top_features(models.importance(spark, result.model), config.top_features), f"{report_path}/importance", "csv"
        )
        files.sink_stage(result.predictions, f"{report_path}/predictions")
    if warehouse is not None:
        warehouse.log_model_metrics(
            metrics, best_params=asdict(result.settings), n_features=len(result.features),
            n_train_samples=result.train_rows, n_test_samples=result.test_rows,
            training_duration_seconds=time.monotonic() - started,
        )
    return result
