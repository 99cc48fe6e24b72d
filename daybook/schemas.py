"""Explicit schemas, required columns and the CamelCase <-> snake_case maps of the durable tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# Text reads: every file column arrives as a string and is coerced by `clean.coerce_types`,
# so a malformed cell becomes NULL instead of failing the scan.
SALES_COLUMNS = (
    "Store", "DayOfWeek", "Date", "Sales", "Customers", "Open", "Promo", "StateHoliday", "SchoolHoliday",
)
STORE_COLUMNS = (
    "Store", "StoreType", "Assortment", "CompetitionDistance", "CompetitionOpenSinceMonth",
    "CompetitionOpenSinceYear", "Promo2", "Promo2SinceWeek", "Promo2SinceYear", "PromoInterval",
)
REQUIRED_SALES = ("Store", "Date", "Sales", "Open", "DayOfWeek", "Promo")
REQUIRED_STORE = ("Store", "StoreType", "Assortment")
REQUIRED_HISTORY = ("Store", "Date", "Sales", "DayOfWeek", "Promo", "StateHoliday", "SchoolHoliday")
REQUIRED_FEATURE_INPUT = ("Store", "Date", "Sales", "DayOfWeek", "Promo")
REQUIRED_PREDICTIONS = ("Store", "Date", "PredictedSales", "ActualSales")

STORE_SCHEMA = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("StoreType", T.StringType()),
    T.StructField("Assortment", T.StringType()),
    T.StructField("CompetitionDistance", T.DoubleType()),
    T.StructField("CompetitionOpenSinceMonth", T.DoubleType()),
    T.StructField("CompetitionOpenSinceYear", T.DoubleType()),
    T.StructField("Promo2", T.IntegerType()),
    T.StructField("Promo2SinceWeek", T.DoubleType()),
    T.StructField("Promo2SinceYear", T.DoubleType()),
    T.StructField("PromoInterval", T.StringType()),
])

SALES_HISTORY = T.StructType([
    T.StructField("store_id", T.IntegerType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("sales", T.DoubleType(), False),
    T.StructField("day_of_week", T.IntegerType(), False),
    T.StructField("promo", T.IntegerType(), False),
    T.StructField("state_holiday", T.StringType()),
    T.StructField("school_holiday", T.IntegerType()),
    T.StructField("created_at", T.TimestampType()),
])
PREDICTIONS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("store_id", T.IntegerType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("predicted_sales", T.DoubleType(), False),
    T.StructField("actual_sales", T.DoubleType()),
    T.StructField("absolute_error", T.DoubleType()),
    T.StructField("percentage_error", T.DoubleType()),
    T.StructField("created_at", T.TimestampType()),
])
PIPELINE_RUNS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("dag_name", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("started_at", T.TimestampType(), False),
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("records_processed", T.LongType()),
    T.StructField("mape", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("r2_score", T.DoubleType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("model_version", T.StringType()),
])
MODEL_METRICS = T.StructType([
    T.StructField("trained_at", T.TimestampType(), False),
    T.StructField("model_version", T.StringType(), False),
    T.StructField("mape", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("r2_score", T.DoubleType()),
    T.StructField("n_features", T.LongType()),
    T.StructField("n_train_samples", T.LongType()),
    T.StructField("n_test_samples", T.LongType()),
    T.StructField("best_params", T.StringType()),
    T.StructField("training_duration_seconds", T.DoubleType()),
])
TABLES = {
    "sales_history": SALES_HISTORY,
    "predictions": PREDICTIONS,
    "pipeline_runs": PIPELINE_RUNS,
    "model_metrics": MODEL_METRICS,
}

HISTORY_MAP = {
    "Store": "store_id",
    "Date": "date",
    "Sales": "sales",
    "DayOfWeek": "day_of_week",
    "Promo": "promo",
    "StateHoliday": "state_holiday",
    "SchoolHoliday": "school_holiday",
}
PREDICTION_MAP = {
    "Store": "store_id",
    "Date": "date",
    "PredictedSales": "predicted_sales",
    "ActualSales": "actual_sales",
    "AbsoluteError": "absolute_error",
    "PercentageError": "percentage_error",
}
RUN_LOG_FIELDS = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("dag_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("tasks_executed", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("duration_seconds", T.DoubleType()),
])


def text_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def require_columns(present: Iterable[str], required: Iterable[str], what: str) -> None:
    have = set(present)
    missing = [c for c in required if c not in have]
    if missing:
        raise ValueError(f"{what}: required columns are missing: {missing}")
