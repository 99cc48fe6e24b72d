from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from daybook.operators import runs
from daybook.sources import files


def log(spark, statuses):
    entries = [
        {"timestamp": f"2026-03-{n + 1:02d}T02:00:00", "dag_name": "daily", "status": s, "tasks_executed": 0,
         "error": None if s == "success" else "x", "duration_seconds": float(n)}
        for n, s in enumerate(statuses)
    ]
    return runs.parse_run_log(spark.createDataFrame([(json.dumps({"dag_runs": entries}),)], "value string"))


def test_success_rate_of_the_published_log(spark):
    row = runs.success_rate(log(spark, ["failed", "failed"] + ["success"] * 11)).first()
    assert (row.total_runs, row.successful_runs) == (13, 11) and row.success_rate == pytest.approx(84.61538461538461)
    assert str(row.last_success) == "2026-03-13 02:00:00"
    assert runs.success_rate(log(spark, ["success", "success", "failed"])).first().success_rate == pytest.approx(66.6667, abs=1e-3)
    assert runs.success_rate(log(spark, [])).first().success_rate == 0


@pytest.mark.parametrize("statuses,streak,alerts", [
    (["success"] * 9 + ["failed"], 1, (False, False)),
    (["success"] * 10 + ["failure", "failed"], 2, (True, False)),
    (["failed", "failed", "failed"], 3, (True, True)),
    (["failed", "success"], 0, (False, True)),
])
def test_failure_streak(spark, statuses, streak, alerts):
    row = runs.failure_streak(log(spark, statuses)).first()
    assert (row.failure_streak, (row.streak_alert, row.rate_alert)) == (streak, alerts)


def test_only_the_last_runs_are_kept(spark):
    df = log(spark, ["failed"] * 5 + ["success"] * 5)
    assert runs.last_n_runs(df, 3).where("status = 'success'").count() == 3
    row = runs.recent_failures(df, 7).first()
    assert (row.recent_runs, row.failures, row.average_duration) == (7, 2, 6.0)
    assert row.failed_runs.split(",") == ["daily_2026-03-04T02:00:00", "daily_2026-03-05T02:00:00"]
    document = runs.run_log_document(runs.last_n_runs(df, 3)).first()["value"]
    assert len(json.loads(document)["dag_runs"]) == 3


@pytest.mark.parametrize("train,model,predictions,age,score,status", [
    (False, False, False, None, 0, "critical"),
    (True, True, True, 1.0, 100, "healthy"),
    (True, True, True, 30.0, 75, "healthy"),
    (True, True, False, 30.0, 50, "degraded"),
])
def test_health(spark, train, model, predictions, age, score, status):
    df = spark.createDataFrame([(train, model, predictions, age)], "t boolean, m boolean, p boolean, a double")
    row = df.select(*[c.alias(n) for n, c in runs.system_health(F.col("t"), F.col("m"), F.col("p"), F.col("a")).items()]).first()
    assert (row.health_score, row.health_status) == (score, status)


def test_run_report(spark, root):
    spark.range(3).write.parquet(f"{root}/train")
    inventory = files.file_inventory(spark, {"train": f"{root}/train", "model": f"{root}/model", "predictions": f"{root}/p"})
    row = runs.run_report(log(spark, ["failed"] + ["success"] * 3), inventory).first()
    assert (row.total_runs, row.success_rate, row.recent_failures) == (4, 75.0, 1)
    assert (row.training_data_exists, row.model_exists, row.health_score, row.health_status) == (True, False, 50, "degraded")


def test_run_table(spark):
    df = log(spark, ["success"]).withColumns({
        "run_id": F.lit("run_20260301_020000_abcdef"), "records_processed": F.lit(12345), "mape": F.lit(9.705),
        "duration_seconds": F.lit(61.6),
    })
    assert tuple(runs.run_table(df).first()) == ("20260301_020000", "success", "01.03 02:00", "62s", "12,345", "9.71%")
