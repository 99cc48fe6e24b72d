"""Forecast quality: metrics, report tables and run comparison.

Input frames carry Store, Date, ActualSales and PredictedSales unless stated otherwise.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.config import DEFAULT_CONFIG
from daybook.functions import errors
from daybook.operators.quantiles import exact_percentiles
from daybook.session import materialize

def _a():
    return F.col("ActualSales")


def _p():
    return F.col("PredictedSales")


def enrich_errors(df: DataFrame) -> DataFrame:
    """Adds AbsoluteError and PercentageError where the frame does not have them yet."""
    if "AbsoluteError" not in df.columns:
        df = df.withColumn("AbsoluteError", errors.absolute_error(_a(), _p()))
    if "PercentageError" not in df.columns:
        df = df.withColumn("PercentageError", errors.percentage_error(_a(), F.col("AbsoluteError")))
    return df


def detail_table(df: DataFrame, limit: int = DEFAULT_CONFIG.detail_rows) -> DataFrame:
    """First rows by (Date, Store) with the signed error; a top-k, not a global sort."""
    error = _a() - _p()
    return (
        df.select(
            "Store", "Date", "ActualSales", "PredictedSales",
            error.alias("Error"),
            F.when(_a() > 0, F.round(error / _a() * 100, 2)).otherwise(0.0).alias("ErrorPct"),
        )
        .orderBy("Date", "Store")
        .limit(limit)
    )


def forecast_metrics(df: DataFrame) -> DataFrame:
    """One row: MAE, RMSE, MAPE, RMSPE, R2, MaxError, MedAE, Bias, Samples."""
    pairs = materialize(df.select(_a().cast("double").alias("ActualSales"), _p().cast("double").alias("PredictedSales")))
    error = _a() - _p()
    relative = error / F.greatest(_a(), F.lit(1.0))
    n = F.count(F.lit(1))
    median = exact_percentiles(pairs, F.abs(error), (0.5,)).select(F.col("q")[0])
    return pairs.agg(
        F.avg(F.abs(error)).alias("MAE"),
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        errors.mape_floor_one(_a(), _p()).alias("MAPE"),
        (F.sqrt(F.avg(relative * relative)) * 100).alias("RMSPE"),
        (F.lit(1.0) - F.try_divide(F.sum(error * error), F.var_pop(_a()) * n)).alias("R2"),
        F.max(F.abs(error)).alias("MaxError"),
        F.avg(error).alias("Bias"),
        n.alias("Samples"),
    ).withColumn("MedAE", median.scalar())


def dashboard_metrics(df: DataFrame) -> DataFrame:
    """One row over the pairs without nulls, rounded to two places; all null but the count when there are none."""
    error = _a() - _p()
    stats = df.where(_a().isNotNull() & _p().isNotNull()).agg(
        errors.mape_positive_only(_a(), _p()).alias("mape"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.sum(_a()).alias("total_sales"),
        F.avg(error).alias("bias"),
        F.stddev_pop(error).alias("std_error"),
        F.count(F.lit(1)).alias("data_points"),
    )
    some = F.col("data_points") > 0
    return stats.select(
        *[F.when(some, F.round(c, 2)).alias(c) for c in stats.columns if c != "data_points"], "data_points"
    )


def safe_mape(df: DataFrame) -> DataFrame:
    return df.agg(errors.mape_positive_only(_a(), _p()).alias("mape"))


def batch_summary(df: DataFrame) -> DataFrame:
    rows = materialize(enrich_errors(df).select("Store", "Date", "AbsoluteError", "PercentageError"))
    median = exact_percentiles(rows, F.col("AbsoluteError"), (0.5,)).select(F.col("q")[0])
    return rows.agg(
        F.count(F.lit(1)).alias("predictions"),
        F.countDistinct("Store").alias("stores"),
        F.min("Date").alias("date_from"),
        F.max("Date").alias("date_to"),
        F.avg("AbsoluteError").alias("mae"),
        F.avg("PercentageError").alias("mape"),
    ).withColumn("medae", median.scalar())


def forecast_series(df: DataFrame) -> DataFrame:
    """Chain totals per day. One store has one row per day, so its totals are its rows."""
    return df.groupBy("Date").agg(F.sum(_a()).alias("ActualSales"), F.sum(_p()).alias("PredictedSales"))


def forecast_header(df: DataFrame) -> DataFrame:
    """MAPE and RMSE of the daily series and the number of stores behind it."""
    error = _a() - _p()
    stores = df.agg(F.countDistinct("Store"))
    return forecast_series(df).agg(
        errors.mape_positive_only(_a(), _p()).alias("mape"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.count(F.lit(1)).alias("points"),
    ).withColumn("stores", stores.scalar())


def store_comparison(df: DataFrame, start: date | str | None = None, end: date | str | None = None) -> DataFrame:
    """Per store: mean / deviation / total of actual, mean of predicted, MAPE over actual > 0 (0 if none)."""
    if start is not None:
        df = df.where(F.col("Date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("Date") <= F.lit(end).cast("date"))
    return df.groupBy("Store").agg(
        F.round(F.avg(_a()), 2).alias("AvgSales"),
        F.round(F.stddev_samp(_a()), 2).alias("StdSales"),
        F.round(F.sum(_a()), 2).alias("TotalSales"),
        F.round(F.avg(_p()), 2).alias("AvgPredicted"),
        errors.mape_positive_only(_a(), _p()).alias("MAPE"),
    )


def attach_group_metric(groups: DataFrame, metric: DataFrame, key: str, column: str) -> DataFrame:
    """Aligns a per-key metric to a table of groups; keys without one get 0."""
    return groups.join(metric.select(key, column), key, "left").na.fill({column: 0.0})


def top_stores_plus(comparison: DataFrame, selected: int | None = None, n: int = DEFAULT_CONFIG.top_stores) -> DataFrame:
    """The n best stores by mean sales, and the selected store when it is not among them."""
    top = comparison.orderBy(F.col("AvgSales").desc(), F.col("Store")).limit(n)
    if not selected:
        return top
    extra = comparison.where(F.col("Store") == selected).join(top.select("Store"), "Store", "left_anti")
    return top.unionByName(extra)


def compare_runs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two runs on their common (Store, Date)."""
    left = first.select("Store", "Date", _p().alias("PredictedSales_v1"), "ActualSales")
    right = second.select("Store", "Date", _p().alias("PredictedSales_v2"))
    v1, v2 = F.col("PredictedSales_v1"), F.col("PredictedSales_v2")
    return left.join(right, ["Store", "Date"]).withColumns({
        "PredictionDelta": v2 - v1,
        "DeltaPct": F.when(v1 > 0, (v2 - v1) / v1 * 100).otherwise(0.0),
    })


def prediction_checks(df: DataFrame) -> DataFrame:
    """One row of checks on a stored batch; a null prediction fails both no_nan and no_negative."""
    if "PredictedSales" not in df.columns:
        return df.limit(1).agg(
            F.lit(False).alias("has_column"), F.lit(False).alias("has_data"), F.lit(False).alias("no_negative"),
            F.lit(False).alias("no_nan"), F.lit(False).alias("all_passed"), F.lit("has_column").alias("failed_checks"),
        )
    known = _p().isNotNull() & ~F.isnan(_p().cast("double"))
    checks = df.agg(
        F.lit(True).alias("has_column"),
        (F.count(F.lit(1)) > 0).alias("has_data"),
        F.coalesce(F.bool_and(F.when(known, _p() >= 0).otherwise(F.lit(False))), F.lit(True)).alias("no_negative"),
        F.coalesce(F.bool_and(known), F.lit(True)).alias("no_nan"),
    )
    names = ("has_data", "no_negative", "no_nan")
    failed = F.array_compact(F.array(*[F.when(~F.col(n), F.lit(n)) for n in names]))
    return checks.withColumns({
        "all_passed": F.col("has_data") & F.col("no_negative") & F.col("no_nan"),
        "failed_checks": F.array_join(failed, ","),
    })


def mape_quality_band(df: DataFrame, column: str = "MAPE") -> DataFrame:
    config = DEFAULT_CONFIG
    return df.withColumn("quality", errors.quality_band(F.col(column), config.mape_excellent, config.mape_good))


def forecast_sample(df: DataFrame, n: int = 100) -> DataFrame:
    """First n rows by (Store, Date) with their error, and the mean error over all rows."""
    error = _a() - _p()
    overall = df.agg(F.avg(error))
    return (
        df.select("Store", "Date", "ActualSales", "PredictedSales", error.alias("Error"))
        .orderBy("Store", "Date")
        .limit(n)
        .withColumn("MeanError", overall.scalar())
    )


def rank_models(metrics: DataFrame) -> DataFrame:
    """Models by MAPE ascending with best / worst marks; failed models are left out."""
    ok = metrics.where(F.col("error").isNull()) if "error" in metrics.columns else metrics
    extremes = ok.agg(
        F.struct(
            F.min_by("model", F.struct("MAPE", "model")).alias("best"),
            F.max_by("model", F.struct("MAPE", "model")).alias("worst"),
        )
    ).scalar()
    return ok.withColumns({
        "is_best": F.col("model") == extremes["best"],
        "is_worst": F.col("model") == extremes["worst"],
    }).orderBy("MAPE", "model")
