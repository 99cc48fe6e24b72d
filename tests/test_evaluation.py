from __future__ import annotations

import datetime as dt
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.functions.errors import normal_ppf, quality_band
from daybook.operators import diagnostics, eda, evaluation

DAY = dt.date(2024, 1, 1)
SCHEMA = "Store int, Date date, ActualSales double, PredictedSales double"


def pairs(spark, actual, predicted, store=1):
    return spark.createDataFrame(
        [(store, DAY + dt.timedelta(days=i), a, p) for i, (a, p) in enumerate(zip(actual, predicted))], SCHEMA
    )


@pytest.fixture(scope="module")
def arrays():
    rng = np.random.default_rng(3)
    actual = np.round(np.exp(rng.normal(7, 1, 500)))
    actual[:5] = 0
    return actual, actual * rng.normal(1, 0.2, 500) + rng.normal(0, 20, 500)


@pytest.fixture(scope="module")
def forecast(spark, arrays):
    return pairs(spark, [float(x) for x in arrays[0]], [float(x) for x in arrays[1]])


def test_forecast_metrics(forecast, arrays):
    a, p = arrays
    e, rel = a - p, (a - p) / np.maximum(a, 1)
    row = evaluation.forecast_metrics(forecast).first()
    want = {
        "MAE": np.abs(e).mean(), "RMSE": np.sqrt((e**2).mean()), "MAPE": np.abs(rel).mean() * 100,
        "RMSPE": np.sqrt((rel**2).mean()) * 100, "R2": 1 - (e**2).sum() / ((a - a.mean()) ** 2).sum(),
        "MaxError": np.abs(e).max(), "MedAE": np.median(np.abs(e)), "Bias": e.mean(), "Samples": 500,
    }
    for name, value in want.items():
        assert row[name] == pytest.approx(value), name


def test_three_mape_definitions(spark):
    df = pairs(spark, [0.0, 100.0], [10.0, 90.0])
    assert evaluation.forecast_metrics(df).first().MAPE == pytest.approx((1000 + 10) / 2)
    assert evaluation.safe_mape(df).first().mape == pytest.approx(10)
    assert evaluation.batch_summary(df).first().mape == pytest.approx(5)


def test_enrich_errors(spark):
    rows = evaluation.enrich_errors(pairs(spark, [5100.0, 5900.0, 7200.0, 0.0], [5000.0, 6000.0, 7000.0, 8.0])).collect()
    assert [r.AbsoluteError for r in rows] == [100, 100, 200, 8]
    assert rows[0].PercentageError == pytest.approx(100 / 5100 * 100) and rows[3].PercentageError == 0


def test_dashboard_metrics_edge_cases(spark):
    empty = evaluation.dashboard_metrics(pairs(spark, [], [])).first()
    assert empty.data_points == 0 and empty.mape is None and empty.mae is None
    one = evaluation.dashboard_metrics(pairs(spark, [10.0, None], [7.0, 1.0])).first()
    assert (one.data_points, one.mae, one.std_error, one.mape) == (1, 3.0, 0.0, 30.0)


def test_prediction_checks(spark):
    good = evaluation.prediction_checks(pairs(spark, [1.0], [2.0])).first()
    assert good.all_passed and good.failed_checks == ""
    null = evaluation.prediction_checks(pairs(spark, [1.0, 1.0], [2.0, None])).first()
    assert not null.no_nan and not null.no_negative and null.failed_checks == "no_negative,no_nan"
    negative = evaluation.prediction_checks(pairs(spark, [1.0], [-2.0])).first()
    assert negative.failed_checks == "no_negative"
    assert evaluation.prediction_checks(pairs(spark, [], [])).first().failed_checks == "has_data"
    assert not evaluation.prediction_checks(pairs(spark, [1.0], [2.0]).drop("PredictedSales")).first().all_passed


def test_compare_runs_and_top_stores(spark):
    a, b = pairs(spark, [1.0, 2.0], [0.0, 10.0]), pairs(spark, [1.0, 2.0, 3.0], [5.0, 15.0, 1.0])
    rows = evaluation.compare_runs(a, b).orderBy("Date").collect()
    assert [(r.PredictionDelta, r.DeltaPct) for r in rows] == [(5.0, 0.0), (5.0, 50.0)]
    stores = spark.range(1, 31).select(F.col("id").cast("int").alias("Store"), (F.col("id") * 1.0).alias("AvgSales"))
    top = sorted(r.Store for r in evaluation.top_stores_plus(stores, 3).collect())
    assert top == [3, *range(16, 31)]
    assert evaluation.top_stores_plus(stores, 20).count() == 15 == evaluation.top_stores_plus(stores, 99).count()


def test_rank_models_leaves_failures_out(spark):
    df = spark.createDataFrame([("a", 12.0, None), ("b", 9.0, None), ("c", None, "boom")], "model string, MAPE double, error string")
    rows = evaluation.rank_models(df).collect()
    assert [r.model for r in rows] == ["b", "a"] and rows[0].is_best and rows[1].is_worst


def test_quality_bands(spark):
    df = spark.createDataFrame([(9.99,), (10.0,), (15.0,)], "m double")
    assert [r[0] for r in df.select(quality_band(F.col("m"))).collect()] == ["excellent", "good", "poor"]


def test_normal_quantiles(spark):
    ps = [1e-12, 1e-6, 0.01, 0.074, 0.076, 0.5, 0.7, 0.925, 0.9999, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in ps], "p double").select("p", normal_ppf(F.col("p")).alias("z"))
    assert max(abs(r.z - NormalDist().inv_cdf(r.p)) for r in df.collect()) < 1e-12


def test_qq_points(forecast, arrays):
    residual = np.sort(arrays[0] - arrays[1])
    rows = diagnostics.qq_normal(forecast).orderBy("Rank").toPandas()
    n = len(residual)
    p = (np.arange(1, n + 1) - 0.3175) / (n + 0.365)
    p[-1], p[0] = 0.5 ** (1 / n), 1 - 0.5 ** (1 / n)
    assert np.allclose(rows["Residual"], residual)
    assert np.allclose(rows["Theoretical"], [NormalDist().inv_cdf(x) for x in p])
    fit = diagnostics.qq_fit(diagnostics.qq_normal(forecast)).first()
    slope, intercept = np.polyfit(rows["Theoretical"], rows["Residual"], 1)
    assert (fit.slope, fit.intercept) == (pytest.approx(slope), pytest.approx(intercept))


def acf(x, lags):
    z = x - x.mean()
    return np.array([(z[: len(z) - k] * z[k:]).sum() / (z * z).sum() for k in range(lags + 1)])


def test_residual_acf_averages_the_long_stores(spark, arrays):
    e = [arrays[0][:200], arrays[0][200:380], arrays[0][380:400]]
    df = pairs(spark, [float(v) for v in e[0]], [0.0] * 200, 1)
    df = df.union(pairs(spark, [float(v) for v in e[1]], [0.0] * 180, 2)).union(pairs(spark, [float(v) for v in e[2]], [0.0] * 20, 3))
    rows = diagnostics.residual_acf(df).orderBy("lag").toPandas()
    assert np.allclose(rows["acf"], (acf(e[0], 60) + acf(e[1], 60)) / 2)
    assert set(rows["stores_used"]) == {2} and rows["band"].iloc[0] == pytest.approx(1.96 / np.sqrt(400 / 3))
    pooled = diagnostics.residual_acf_pooled(df, 15).orderBy("lag").toPandas()
    z = [x - x.mean() for x in e]
    sums = [sum((x[: len(x) - k] * x[k:]).sum() for x in z) for k in range(16)]
    assert np.allclose(pooled["acf"], np.array(sums) / sums[0]) and set(pooled["stores_used"]) == {3}


def test_quintile_bins_are_closed_at_the_top(forecast, arrays):
    a, p = arrays
    edges = np.percentile(p, [0, 20, 40, 60, 80, 100])
    bins = np.clip(np.digitize(p, edges[:-1]) - 1, 0, 4)
    rows = diagnostics.residuals_by_quintile(forecast).orderBy("bin").collect()
    assert [r.n for r in rows] == [int((bins == b).sum()) for b in range(5)]
    for b, r in enumerate(rows):
        part = (a - p)[bins == b]
        assert (r.q1, r.median, r.q3) == tuple(pytest.approx(v) for v in np.percentile(part, [25, 50, 75]))


def test_error_distribution(spark, forecast, arrays):
    a, p = arrays
    v = ((a - p) / np.where(a > 0, a, 1) * 100)[a > 0]
    lo, hi = np.percentile(v, [1, 99])
    row = diagnostics.error_pct_stats(forecast).first()
    assert (row.n, row.n_clipped) == (len(v), int(((v < lo) | (v > hi)).sum()))
    assert (row["std"], row["median"]) == (pytest.approx(v.std()), pytest.approx(np.median(v)))
    small = diagnostics.error_pct_stats(pairs(spark, [10.0] * 20, [float(x) for x in range(20)])).first()
    assert small.n_clipped == 0 and (small.display_low, small.display_high) == (small["min"], small["max"])

    shown = v[(v >= lo) & (v <= hi)]
    values = diagnostics.displayed_error_pct(forecast)
    q25, q75 = np.percentile(shown, [25, 75])
    width = 0.9 * min(shown.std(ddof=1), (q75 - q25) / 1.34) * len(shown) ** -0.2
    curve = diagnostics.kde(values).orderBy("point").toPandas()
    u = (curve["x"].to_numpy()[:, None] - shown[None, :]) / width
    assert np.allclose(curve["density"], np.exp(-0.5 * u * u).mean(axis=1) / (width * np.sqrt(2 * np.pi)))
    assert diagnostics.kde(values.limit(10)).count() == 0

    n = len(shown)
    fd = np.ceil((shown.max() - shown.min()) / (2 * (q75 - q25) * n ** (-1 / 3)))
    assert diagnostics.adaptive_bins(values).first().bins == int(max(20, min(max(fd, np.ceil(1 + np.log2(n))), 80)))
    hist = diagnostics.histogram(values, 25, density=True).orderBy("bin").toPandas()
    counts, _ = np.histogram(shown, 25)
    density, _ = np.histogram(shown, 25, density=True)
    assert hist["n"].tolist() == counts.tolist() and np.allclose(hist["density"], density)


def test_constant_histogram(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "v double")
    hist = diagnostics.histogram(df, 10).orderBy("bin").toPandas()
    assert hist["n"].tolist() == np.histogram([5.0] * 4, 10)[0].tolist()


def test_business_case_reproduces_the_published_result(spark):
    # One store whose mean daily sales give the published yearly saving.
    case = eda.BusinessCase()
    mape = 9.70066154434849
    daily = 127424.4022 / ((case.loss_rate * (25 - mape) / 100) * case.realization * 50 * 300)
    df = spark.createDataFrame([(1, daily)], "Store int, Sales double")
    row = eda.business_value(df, mape, case).first()
    assert case.development_cost == pytest.approx(5268772.7272727275) and case.yearly_cost == pytest.approx(1337600)
    assert round(row.roi_pct, 2) == 216.46 and round(row.payback_months, 1) == 5.5
    grid = {(r.baseline_error, r.model_error): r for r in eda.scenario_grid(df).collect()}
    assert len(grid) == 25 and grid[(15.0, 15.0)].payback_months == 99


def test_correlations_skip_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5), (2.0, 4.1, 5), (3.0, 5.9, 5)], "Sales double, x double, c int")
    cells = {(r.a, r.b): r["corr"] for r in eda.correlation_matrix(df).collect()}
    assert len(cells) == 9 and cells[("c", "Sales")] is None and cells[("x", "Sales")] == cells[("Sales", "x")]
    assert [r.feature for r in eda.correlation_with(df).collect()] == ["x"]
