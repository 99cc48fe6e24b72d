"""Prediction runs and the job-run log.

The log may hold any number of runs: "last" is always a distributed top-k and every rate an aggregate, never a
window over the whole log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.config import DEFAULT_CONFIG
from daybook.schemas import RUN_LOG_FIELDS


def normalize_status(status: Column) -> Column:
    """Writers say 'failure' or 'failed' for the same thing."""
    return F.when(F.lower(status).isin("failure", "failed"), "failed").otherwise(F.lower(status))


def parse_run_log(documents: DataFrame, column: str = "value") -> DataFrame:
    """JSON monitoring documents -> one row per run."""
    schema = T.StructType([T.StructField("dag_runs", T.ArrayType(RUN_LOG_FIELDS))])
    runs = documents.select(F.inline(F.from_json(column, schema)["dag_runs"]))
    return runs.select(
        F.col("timestamp").cast("timestamp").alias("started_at"),
        F.concat_ws("_", "dag_name", "timestamp").alias("run_id"),
        "dag_name",
        normalize_status(F.col("status")).alias("status"),
        "tasks_executed",
        F.col("error").alias("error_message"),
        "duration_seconds",
    )


def run_log_document(runs: DataFrame) -> DataFrame:
    """The inverse, for the retained runs only (bounded by `last_n_runs`)."""
    entry = F.struct(
        F.col("started_at").cast("string").alias("timestamp"), "dag_name", "status", F.col("error_message").alias("error"),
        "duration_seconds",
    )
    return runs.agg(F.to_json(F.struct(F.sort_array(F.collect_list(entry)).alias("dag_runs"))).alias("value"))


def last_n_runs(runs: DataFrame, n: int = DEFAULT_CONFIG.max_stored_runs) -> DataFrame:
    return runs.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(n)


def success_rate(runs: DataFrame) -> DataFrame:
    ok = normalize_status(F.col("status")) == "success"
    return runs.agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(ok).alias("successful_runs"),
        F.coalesce(F.avg(ok.cast("double")) * 100, F.lit(0.0)).alias("success_rate"),
        F.max(F.when(ok, F.col("started_at"))).alias("last_success"),
    )


def failure_streak(runs: DataFrame) -> DataFrame:
    """Failed runs after the last run that did not fail, and the alerts that follow."""
    config = DEFAULT_CONFIG
    position = F.struct("started_at", "run_id")
    failed = normalize_status(F.col("status")) == "failed"
    last_good = runs.agg(F.max(F.when(~failed, position))).scalar()
    rate = success_rate(runs).select("success_rate").scalar()
    streak = runs.agg(F.count_if(last_good.isNull() | (position > last_good)).alias("failure_streak"))
    return streak.select(
        "failure_streak",
        rate.alias("success_rate"),
        (F.col("failure_streak") >= config.failure_streak_alert).alias("streak_alert"),
        (rate < config.success_rate_alert).alias("rate_alert"),
    )


def recent_failures(runs: DataFrame, n: int = 10) -> DataFrame:
    """Average length of the last n runs and the ids of those that failed, oldest first."""
    recent = last_n_runs(runs, n)
    failed = normalize_status(F.col("status")) == "failed"
    hits = F.sort_array(F.collect_list(F.when(failed, F.struct("started_at", "run_id"))))  # n entries at most
    return recent.agg(
        F.count(F.lit(1)).alias("recent_runs"),
        F.coalesce(F.avg(F.coalesce("duration_seconds", F.lit(0.0))), F.lit(0.0)).alias("average_duration"),
        F.count_if(failed).alias("failures"),
        F.array_join(F.transform(hits, lambda h: h["run_id"]), ",").alias("failed_runs"),
    )


def recent_records(df: DataFrame, by: str, limit: int = 20) -> DataFrame:
    return df.orderBy(F.col(by).desc()).limit(limit)


def run_table(runs: DataFrame, limit: int = 20) -> DataFrame:
    """Display rows of the last runs: short id, status, start, length, records, MAPE."""
    dash = F.lit("-")
    return last_n_runs(runs, limit).select(
        F.substring(F.regexp_replace("run_id", "run_", ""), 1, 15).alias("id"),
        "status",
        F.date_format("started_at", "dd.MM HH:mm").alias("started"),
        F.when(F.coalesce("duration_seconds", F.lit(0.0)) != 0, F.format_string("%.0fs", "duration_seconds")).otherwise(dash).alias("duration"),
        F.format_number(F.coalesce("records_processed", F.lit(0)), 0).alias("records"),
        F.when(F.coalesce("mape", F.lit(0.0)) != 0, F.format_string("%.2f%%", "mape")).otherwise(dash).alias("mape"),
    )


def list_runs(predictions: DataFrame, limit: int = 20) -> DataFrame:
    """Prediction runs, newest first. A run may hold any share of the table: the aggregate combines map-side."""
    return (
        predictions.groupBy("run_id")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min("date").alias("date_from"),
            F.max("date").alias("date_to"),
            F.avg("percentage_error").alias("avg_mape"),
            F.min("created_at").alias("created_at"),
            F.max("created_at").alias("__last"),
        )
        .orderBy(F.col("__last").desc(), F.col("run_id").desc())
        .limit(limit)
        .drop("__last")
    )


def latest_run(predictions: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rows of one run: the given one, or the one written last."""
    if run_id is not None:
        return predictions.where(F.col("run_id") == run_id)
    newest = predictions.agg(F.max_by("run_id", F.struct("created_at", "run_id"))).scalar()
    return predictions.where(F.col("run_id") == newest)


def system_health(train: Column, model: Column, predictions: Column, age_hours: Column) -> dict[str, Column]:
    """25 points each for training data, model, predictions and fresh training data."""
    fresh = F.coalesce(age_hours < DEFAULT_CONFIG.freshness_hours, F.lit(False))
    score = sum((F.when(c, 25).otherwise(0) for c in (train, model, predictions, fresh)), F.lit(0))
    status = F.when(score >= 75, "healthy").when(score >= 50, "degraded").otherwise("critical")
    return {"health_score": score, "health_status": status}


def run_report(runs: DataFrame, inventory: DataFrame, now: Column | None = None) -> DataFrame:
    """One row: totals over the retained runs, the recent ones, data checks and the health score.

    `inventory` is `file_inventory` output with the roles train, model and predictions.
    """
    now = F.current_timestamp() if now is None else now
    kept = last_n_runs(runs)
    recent = recent_failures(runs).select(F.struct("average_duration", "failures", "failed_runs")).scalar()

    def has(role: str) -> Column:
        return F.coalesce(F.bool_or((F.col("name") == role) & F.col("exists")), F.lit(False))

    train_time = F.max(F.when(F.col("name") == "train", F.col("mtime")))
    checks = inventory.agg(
        F.struct(
            has("train").alias("train"), has("model").alias("model"), has("predictions").alias("predictions"),
            F.round((now.cast("double") - train_time.cast("double")) / 3600, 1).alias("age"),
        )
    ).scalar()
    return success_rate(kept).drop("last_success").withColumns({
        "average_duration": recent["average_duration"],
        "recent_failures": recent["failures"],
        "failed_runs": recent["failed_runs"],
        "training_data_exists": checks["train"],
        "model_exists": checks["model"],
        "predictions_exist": checks["predictions"],
        "data_freshness_hours": checks["age"],
        **system_health(checks["train"], checks["model"], checks["predictions"], checks["age"]),
    })
