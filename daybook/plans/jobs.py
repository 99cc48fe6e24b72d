"""Cleaning, feature, history, prediction and validation jobs."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.config import DEFAULT_CONFIG, EngineConfig
from daybook.operators import cleaning, evaluation, history, panel
from daybook.operators.observed import Steps
from daybook.plans.features import align_features, build_features, feature_names
from daybook.session import scratch_path
from daybook.sources.files import sink_stage
from daybook.sources.tables import Warehouse


def new_run_id(now: datetime | None = None) -> str:
    return f"run_{(now or datetime.now()):%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"


def clean_job(
    merged: DataFrame,
    order_by: Sequence[str],
    remove_outliers: bool = False,
    method: str = "iqr",
    threshold: float = 3.0,
    check_fractions: bool = True,
    steps: Steps | None = None,
) -> DataFrame:
    """Types -> last row per (Store, Date) -> valid dates -> open days -> positive sales [-> outliers out].

    The order matters: keys are compared before dates are parsed and before closed days go. `steps` counts the rows each of them
    leaves, in the pass that writes the result.
    """
    count = steps.at if steps else lambda _, rows: rows
    df = count("read", cleaning.coerce_types(merged, check_fractions=check_fractions))
    df = count("unique", cleaning.dedupe_keep_last(df, order_by).drop(*order_by))
    df = count("dated", cleaning.coerce_dates(df))
    df = count("open", cleaning.filter_open(df))
    df = count("positive", cleaning.filter_positive_sales(df))
    if remove_outliers:
        df = cleaning.detect_outliers(df, "Sales", method, threshold).where(~F.col("IsOutlier")).drop("IsOutlier")
        df = count("inside", df)
    return df


def feature_job(cleaned: DataFrame, config: EngineConfig = DEFAULT_CONFIG, steps: Steps | None = None) -> DataFrame:
    """The feature table; `steps` counts nulls of the input (`before`) and of the features (`after`), in the pass that writes it."""
    if steps is None:
        return build_features(cleaned, config)
    built = build_features(steps.at("before", cleaned, cleaned.columns), config)
    return steps.at("after", built, built.columns)


def history_job(warehouse: Warehouse, cleaned: DataFrame) -> DataFrame:
    """Upserts a cleaned batch and returns the statistics of the whole history."""
    warehouse.upsert_history(cleaned)
    return history.history_stats(warehouse.load_history())


def scoring_features(cleaned: DataFrame, past: DataFrame, config: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    """Features of a batch to score: lags come from the history, fills from the batch itself."""
    base = build_features(cleaned, config, lags=False)
    # Cleaned rows are unique on (Store, Date), so they are the requests themselves and no join is needed.
    lagged = panel.batch_lags(base, past, config.lag_days, unique=True)
    filled = panel.expanding_fill(lagged, panel.lag_columns(config.lag_days))
    names = [c for c in feature_names(config) if c in filled.columns]
    return filled.select(*names, "Sales", "Date")


def predict_job(
    merged: DataFrame,
    order_by: Sequence[str],
    warehouse: Warehouse,
    score: Callable[[DataFrame], DataFrame],
    model_features: Sequence[str] | None = None,
    config: EngineConfig = DEFAULT_CONFIG,
    run_id: str | None = None,
) -> tuple[str, DataFrame]:
    """Clean -> upsert the history -> features with lags from it -> score -> errors -> store the run.

    `score` adds the column PredictedSales. Returns the run id and the stored rows. The cleaned batch is used
    several times, so it is staged in the shared folder, which also cuts the lineage for lost executors.
    """
    spark = merged.sparkSession
    staged = scratch_path(spark, "cleaned")
    sink_stage(clean_job(merged, order_by), staged)
    cleaned = spark.read.parquet(staged)
    if cleaned.isEmpty():
        raise ValueError("no rows left to predict after cleaning")
    warehouse.upsert_history(cleaned)
    past = warehouse.load_history(since=panel.history_since(cleaned, config.lag_days))
    features = scoring_features(cleaned, past, config)
    scored = score(align_features(features, model_features))
    results = evaluation.enrich_errors(
        scored.select("Store", "Date", "PredictedSales", F.col("Sales").alias("ActualSales"))
    )
    run_id = run_id or new_run_id()
    warehouse.append_predictions(results, run_id)
    return run_id, warehouse.run_predictions(run_id)


def validate_job(predictions: DataFrame) -> DataFrame:
    return evaluation.prediction_checks(predictions)


class StepLog:
    """Logs each step of a run to the warehouse with its length, record count, metrics or error, and re-raises."""

    def __init__(self, warehouse: Warehouse, run_id: str | None = None) -> None:
        self.warehouse = warehouse
        self.run_id = run_id or new_run_id()

    def run(self, step: str, work: Callable[[], dict[str, object] | None]) -> dict[str, object]:
        started, clock = datetime.now(), time.monotonic()
        try:
            outcome = work() or {}
        except Exception as error:
            self.warehouse.log_run(
                self.run_id, step, "failed", started_at=started, duration_seconds=time.monotonic() - clock,
                error_message=str(error),
            )
            raise
        self.warehouse.log_run(
            self.run_id, step, "success", started_at=started, duration_seconds=time.monotonic() - clock, **outcome
        )
        return outcome
