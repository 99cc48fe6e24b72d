"""Spark ML models: baselines, boosted trees with a time-based stop (see `boosting`), search, scoring, importance."""

from __future__ import annotations

import random
import statistics
import time
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.config import DEFAULT_CONFIG, EngineConfig
from daybook.functions.calendar import log_target, unlog_target
from daybook.ml import split
from daybook.ml.boosting import RUNG_ROUNDS, Binned, BoostSettings, Trial, bin_rows, fit_rounds, fit_with_stop, race, sample_settings
from daybook.operators.evaluation import forecast_metrics, rank_models
from daybook.sources.files import path_exists

NOT_FEATURES = ("Date", "Sales", "Customers", "Open", split.WEEK, "label", "features", "is_validation", "IsTrain")
METRIC_SCHEMA = (
    "model string, MAE double, RMSE double, MAPE double, RMSPE double, R2 double, MaxError double, Bias double, "
    "Samples bigint, MedAE double, training_time_seconds double, error string"
)


def model_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NOT_FEATURES]


def assembler(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="keep")


def assemble(df: DataFrame, columns: Sequence[str] | None = None, log: bool = False) -> DataFrame:
    """`features` vector and `label` (Sales, or its log1p)."""
    columns = list(columns or model_columns(df))
    label = log_target(F.col("Sales")) if log else F.col("Sales").cast("double")
    return assembler(columns).transform(df.withColumn("label", label))


def _metrics_row(name: str, scored: DataFrame, seconds: float) -> DataFrame:
    row = forecast_metrics(scored).withColumns({
        "model": F.lit(name),
        "training_time_seconds": F.lit(float(seconds)),
        "error": F.lit(None).cast("string"),
    })
    return row.select(*[c.split()[0] for c in METRIC_SCHEMA.split(", ")])


# --- baselines --------------------------------------------------------------------------------------------


def score_mean(train: DataFrame, test: DataFrame) -> DataFrame:
    mean = train.agg(F.avg("Sales")).scalar()
    return test.select("Store", "Date", F.col("Sales").alias("ActualSales"), mean.alias("PredictedSales"))


@dataclass(frozen=True)
class ForestSettings:
    """Depth is limited to keep a tree's nodes in an executor's memory; a deeper limit is a parameter away."""

    trees: int = 100
    depth: int = 10
    seed: int = DEFAULT_CONFIG.random_state


def baselines(train: DataFrame, test: DataFrame, forest: ForestSettings = ForestSettings()) -> tuple[DataFrame, dict[str, object]]:
    """Linear regression, random forest and the mean on the raw target: one metrics row per model.

    A model that fails becomes a row with `error`; the others go on.
    """
    spark = train.sparkSession
    columns = model_columns(train)
    fit_rows = assemble(train, columns).select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    test_rows = assemble(test, columns)
    estimators = {
        "LinearRegression": LinearRegression(),
        "RandomForest": RandomForestRegressor(numTrees=forest.trees, maxDepth=forest.depth, seed=forest.seed),
        "MeanBaseline": None,
    }
    rows, models = [], {}
    try:
        for name, estimator in estimators.items():
            started = time.monotonic()
            try:
                if estimator is None:
                    scored = score_mean(train, test)
                else:
                    models[name] = estimator.fit(fit_rows)
                    scored = models[name].transform(test_rows).select(
                        "Store", "Date", F.col("Sales").alias("ActualSales"), F.col("prediction").alias("PredictedSales")
                    )
                rows.append(tuple(_metrics_row(name, scored, time.monotonic() - started).first()))
            except Exception as error:  # noqa: BLE001 - reported as a row
                rows.append((name, *[None] * 9, 0.0, str(error)))
    finally:
        fit_rows.unpersist()
    return spark.createDataFrame(rows, METRIC_SCHEMA), models


# --- boosted trees ----------------------------------------------------------------------------------------


def score_log(model: object, rows: DataFrame) -> DataFrame:
    """Model on log1p(Sales) -> PredictedSales in sales units."""
    return model.transform(rows).select(
        "Store", "Date", F.col("Sales").alias("ActualSales"), unlog_target(F.col("prediction")).alias("PredictedSales")
    )


def param_search(
    search: DataFrame, base: BoostSettings = BoostSettings(), trials: int = DEFAULT_CONFIG.search_trials,
    splits: int = DEFAULT_CONFIG.cv_splits, seed: int = DEFAULT_CONFIG.random_state, parallel: int = 8, rung: int = RUNG_ROUNDS,
) -> list[Trial]:
    """Seeded random search minimising the mean MAPE over expanding week folds: finished trials first, best first.

    Trials race over one binned table: see `boosting.race`. A dropped trial keeps the score it was dropped with.
    """
    search = split.with_week_key(search)
    table = bin_rows(search)
    try:
        return search_binned(table, search, base, trials, splits, seed, parallel, rung)
    finally:
        table.close()


def search_binned(
    table: Binned, search: DataFrame, base: BoostSettings, trials: int, splits: int, seed: int, parallel: int = 8, rung: int = RUNG_ROUNDS
) -> list[Trial]:
    """`param_search` over rows that are binned already; `table` may hold later weeks too."""
    folds = split.expanding_folds(split.week_keys(search), splits)
    rng = random.Random(seed)
    planned = [Trial(n, sample_settings(rng, base)) for n in range(trials)]

    return race(table, folds, planned, absolute_percent, rung, parallel)


def absolute_percent(label: np.ndarray, prediction: np.ndarray) -> np.ndarray:
    """Terms of the MAPE of `forecast_metrics` from log1p values."""
    actual, predicted = np.expm1(label), np.expm1(prediction)
    return np.abs(actual - predicted) / np.maximum(actual, 1.0) * 100


def trial_table(spark: SparkSession, trials: Sequence[Trial]) -> DataFrame:
    rows = [
        (t.number, t.score, int(statistics.median(t.iterations)), sum(t.rounds), t.pruned, t.settings.depth, t.settings.bins, t.settings.step,
         t.settings.min_rows, t.settings.row_fraction, t.settings.feature_fraction)
        for t in trials
    ]
    return spark.createDataFrame(
        rows, "trial int, mape double, trees int, rounds_fitted int, pruned boolean, depth int, bins int, step double, min_rows int, "
        "row_fraction double, feature_fraction double"
    )


@dataclass
class Training:
    model: PipelineModel
    settings: BoostSettings
    iterations: int
    metrics: DataFrame
    predictions: DataFrame
    features: list[str]
    train_rows: int
    test_rows: int


def train_boosted(
    train: DataFrame, test: DataFrame, settings: BoostSettings | None = None, config: EngineConfig = DEFAULT_CONFIG,
    base: BoostSettings = BoostSettings(), parallel: int = 8,
) -> Training:
    """Nested holdout: search (unless settings are given) and stop point on the early weeks, then a refit on all
    training weeks with the number of trees fixed."""
    columns = model_columns(train)
    stage = assembler(columns)
    started = time.monotonic()
    keep = ("Store", "Date", "Sales", split.WEEK, "features", "label")
    fit_all = assemble(split.with_week_key(train), columns, log=True).select(*keep).persist(StorageLevel.MEMORY_AND_DISK)
    table = bin_rows(fit_all)
    try:
        search, holdout = split.holdout_split(fit_all, config.holdout_ratio)
        if settings is None:
            settings = search_binned(table, search, base, config.search_trials, config.cv_splits, config.random_state, parallel)[0].settings
        early, late = split.week_keys(search), split.week_keys(holdout)
        best = fit_with_stop(table, (early[0], early[-1]), (late[0], late[-1]), settings).best
        final = fit_rounds(table, settings, best).model(best)
        train_rows = fit_all.count()
    finally:
        table.close()
        fit_all.unpersist()
    pipeline = PipelineModel(stages=[stage, final])
    predictions = score_log(pipeline, test)
    metrics = _metrics_row("BoostedTrees", predictions, time.monotonic() - started)
    return Training(pipeline, settings, best, metrics, predictions, columns, train_rows, test.count())


# --- model files, scoring, importance ---------------------------------------------------------------------


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"model not found: {path}")
    return PipelineModel.load(path)


def feature_list(model: PipelineModel) -> list[str]:
    """Feature names in model order, as stored with the model."""
    return list(model.stages[0].getInputCols())


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds PredictedSales and keeps the input columns."""
    scored = model.transform(df).withColumn("PredictedSales", unlog_target(F.col("prediction")))
    return scored.drop("features", "prediction")


def importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(feature_list(model), values)]
    return spark.createDataFrame(rows, "feature string, importance double")


def top_features(importances: DataFrame, n: int = DEFAULT_CONFIG.top_features) -> DataFrame:
    """The n most important features in ascending order, normalised, with their total."""
    top = importances.orderBy(F.col("importance").desc(), "feature").limit(n)
    span = top.agg(
        F.struct(F.min("importance").alias("lo"), F.max("importance").alias("hi"), F.sum("importance").alias("total"))
    ).scalar()
    return top.select(
        "feature", "importance",
        ((F.col("importance") - span["lo"]) / F.greatest(span["hi"] - span["lo"], F.lit(1e-9))).alias("normalized"),
        span["total"].alias("total_importance"),
    ).orderBy("importance", "feature")


def model_comparison(*metrics: DataFrame) -> DataFrame:
    stacked = metrics[0]
    for m in metrics[1:]:
        stacked = stacked.unionByName(m)
    return rank_models(stacked)
