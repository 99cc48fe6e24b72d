"""A third of all rows on one key: same results, and no plan that gathers the key whole."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.operators import diagnostics, evaluation, history, panel, quantiles
from daybook.plans.jobs import clean_job


@pytest.fixture(scope="module")
def raw(spark):
    n = F.col("id")
    hot = n % 3 == 0
    return spark.range(30_000).select(
        F.when(hot, F.lit("1")).otherwise((n % 40).cast("string")).alias("Store"),
        F.when(hot, F.lit("2024-05-05")).otherwise(F.date_add(F.lit("2024-01-01"), (n % 200).cast("int")).cast("string")).alias("Date"),
        (n % 977 + 1).cast("string").alias("Sales"),
        F.lit("1").alias("Open"),
        F.lit("3").alias("DayOfWeek"),
        (n % 2).cast("string").alias("Promo"),
        F.lit("0").alias("StateHoliday"),
        F.lit("0").alias("SchoolHoliday"),
        n.alias("seq"),
    )


def test_hot_key_is_reduced_before_the_shuffle(raw):
    pdf = raw.toPandas().sort_values("seq").drop_duplicates(["Store", "Date"], keep="last")
    cleaned = clean_job(raw, ["seq"], check_fractions=False)
    got = {(r.Store, str(r.Date)): r.Sales for r in cleaned.collect()}
    assert got == {(int(s), d): float(v) for s, d, v in zip(pdf["Store"], pdf["Date"], pdf["Sales"])}
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_history_merge_with_a_hot_key(spark, raw):
    new = raw.select(
        F.col("Store").cast("int").alias("Store"), F.to_date("Date").alias("Date"), F.col("Sales").cast("double").alias("Sales"),
        F.lit(1).alias("DayOfWeek"), F.lit(0).alias("Promo"), F.lit("0").alias("StateHoliday"), F.lit(0).alias("SchoolHoliday"), "seq",
    )
    merged = history.merge_history(new.drop("seq").limit(0), new, "seq")
    last = new.agg(F.max(F.when((F.col("Store") == 1) & (F.col("Date") == "2024-05-05"), F.struct("seq", "Sales")))).first()[0]
    hot = merged.where("Store = 1 and Date = date '2024-05-05'").collect()
    assert len(hot) == 1 and hot[0].Sales == last.Sales


def test_repeated_lag_requests_are_computed_once(spark, raw):
    days = raw.select(F.col("Store").cast("int").alias("Store"), F.to_date("Date").alias("Date"))
    past = days.distinct().withColumn("Sales", F.lit(2.0))
    out = panel.batch_lags(days, past, (7,))
    assert out.count() == 30_000
    assert out.where("RollingMean_7 <> 2.0").count() == 0
    assert out.select("Store", "Date", "RollingMax_7").distinct().count() == past.count()


def test_errors_with_a_third_of_ties(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "DISTINCT_LIMIT", 500)
    monkeypatch.setattr(quantiles, "TIE_CHUNK", 1_000)
    rng = np.random.default_rng(2)
    actual = rng.integers(1, 5_000, 9_000).astype(float)
    predicted = np.where(np.arange(9_000) % 3 == 0, actual, actual * rng.normal(1, 0.3, 9_000))
    df = spark.createDataFrame([(float(a), float(p)) for a, p in zip(actual, predicted)], "ActualSales double, PredictedSales double")
    error = np.sort(np.abs(actual - predicted))
    cdf = diagnostics.abs_error_cdf(df).orderBy("CumulativePct").toPandas()
    assert np.allclose(cdf["AbsError"], error) and np.allclose(cdf["CumulativePct"], np.arange(1, 9_001) / 90)
    assert evaluation.forecast_metrics(df).first().MedAE == pytest.approx(np.median(error))
