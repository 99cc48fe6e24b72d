from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.operators import cleaning, imputation
from daybook.plans.jobs import clean_job

SALES = "Store string, Date string, Sales string, Open string, DayOfWeek string, Promo string, seq int"


def sales(spark, rows):
    return spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], SALES)


def test_closed_and_zero_rows_go(spark):
    df = sales(spark, [
        ("1", "2024-01-01", "1000", "1", "1", "1"),
        ("1", "2024-01-02", "0", "1", "2", "0"),
        ("2", "2024-01-01", "800", "0", "1", "1"),
        ("2", "2024-01-02", "900", "1", "2", "0"),
    ])
    assert clean_job(df, ["seq"]).count() == 2


def test_invalid_date_is_dropped_after_dedupe(spark):
    df = sales(spark, [("1", "invalid-date", "5", "1", "1", "0"), ("1", "2024-01-02", "6", "1", "2", "0")])
    assert [r.Sales for r in clean_job(df, ["seq"]).collect()] == [6.0]


def test_closed_duplicate_evicts_the_open_row(spark):
    df = sales(spark, [("1", "2024-01-02", "5", "1", "2", "0"), ("1", "2024-01-02", "7", "0", "2", "0")])
    assert clean_job(df, ["seq"]).count() == 0


def test_last_duplicate_wins(spark):
    df = sales(spark, [("1", "2024-01-02", str(v), "1", "2", "0") for v in (5, 9, 7)])
    assert [r.Sales for r in clean_job(df, ["seq"]).collect()] == [7.0]


def test_dedupe_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("Store"), F.lit("x").alias("Date"), F.col("id").alias("seq"))
    plan = cleaning.dedupe_keep_last(df, ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_bad_numbers_become_null_and_integers_narrow(spark):
    df = spark.createDataFrame([("1.0", "abc", "2"), ("2", "7.5", None)], "Store string, Sales string, Open string")
    out = cleaning.coerce_types(df)
    assert [tuple(r) for r in out.orderBy("Store").collect()] == [(1, None, 2), (2, 7.5, None)]
    assert dict(out.dtypes)["Store"] == "int"


def test_fractional_integer_column_stays_double(spark):
    df = spark.createDataFrame([("1.5",), (None,)], "Promo2 string")
    assert dict(cleaning.coerce_types(df).dtypes)["Promo2"] == "double"


def panel(spark, values, promo):
    return spark.createDataFrame([(float(v), p) for v, p in zip(values, promo)], "Sales double, Promo int")


@pytest.mark.parametrize("method,threshold", [("iqr", 1.5), ("zscore", 2.0)])
def test_outliers_per_promo_regime(spark, method, threshold):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(100, 5, 60), [200], rng.normal(500, 5, 60), [900]])
    promo = [0] * 61 + [1] * 61
    got = {r.Sales: r.IsOutlier for r in cleaning.detect_outliers(panel(spark, values, promo), method=method, threshold=threshold).collect()}
    for side in (0, 1):
        part = np.array([v for v, p in zip(values, promo) if p == side])
        if method == "iqr":
            q1, q3 = np.percentile(part, [25, 75])
            want = (part < q1 - threshold * (q3 - q1)) | (part > q3 + threshold * (q3 - q1))
        else:
            want = np.abs((part - part.mean()) / part.std(ddof=1)) > threshold
        assert [got[v] for v in part] == list(want)


def test_outliers_with_one_regime_use_all_rows(spark):
    df = panel(spark, [1, 2, 3, 4, 1000], [1] * 5)
    assert [r.Sales for r in cleaning.detect_outliers(df, threshold=1.5).where("IsOutlier").collect()] == [1000.0]


def test_outlier_edge_cases(spark):
    df = panel(spark, [5, 5, 5], [0, 0, 0])
    assert cleaning.detect_outliers(df, method="zscore").where("IsOutlier").count() == 0
    assert cleaning.detect_outliers(df.drop("Sales")).where("IsOutlier").count() == 0
    with pytest.raises(ValueError):
        cleaning.detect_outliers(df, method="other")
    unknown = panel(spark, [1, 1, 1, 1, 1000], [0, 1, 0, 1, None])
    assert cleaning.detect_outliers(unknown, threshold=1.5).where("IsOutlier").count() == 0


def test_clean_job_can_remove_outliers(spark):
    df = sales(spark, [("1", f"2024-01-{d:02d}", str(v), "1", "1", "0") for d, v in enumerate([10, 11, 12, 11, 10, 9000], 1)])
    assert clean_job(df, ["seq"], remove_outliers=True).count() == 5


def test_outlier_stats_of_an_empty_table(spark):
    row = cleaning.outlier_stats(panel(spark, [], [])).first()
    assert (row.total_records, row.outliers_count, row.outliers_percentage, row.normal_min) == (0, 0, 0.0, None)


def test_dashboard_filter_is_inclusive(spark):
    df = spark.sql("select s as Store, date_add(date '2024-01-01', int(d)) as Date from range(0, 2) a(s), range(0, 100) b(d)")
    assert cleaning.filter_dashboard(df, end="2024-02-01", preset="7days").count() == 16
    assert cleaning.filter_dashboard(df, 1, end="2024-02-01", preset="30days").count() == 31
    assert cleaning.filter_dashboard(df, preset="all").count() == 200
    assert cleaning.filter_dashboard(df, start="2024-01-01").count() == 0


def test_impute_constants_flags_modes_and_medians(spark):
    df = spark.createDataFrame(
        [
            (1, 100.0, 5.0, 2000.0, None, 1, "a", 4.0),
            (1, None, None, None, None, None, None, None),
            (1, 50.0, 1.0, 2001.0, 2010.0, 0, "b", 8.0),
            (2, 70.0, 2.0, 2002.0, None, 0, "b", None),
        ],
        "Store int, CompetitionDistance double, CompetitionOpenSinceMonth double, CompetitionOpenSinceYear double, "
        "Promo2SinceYear double, Promo int, StateHoliday string, Customers double",
    )
    rows = imputation.impute(df).orderBy("Store", F.col("CompetitionDistance").desc()).collect()
    filled = rows[0]
    assert (filled.CompetitionDistance, filled.HasCompetition, filled.InPromo2) == (100000.0, 0, 0)
    assert (filled.Promo, filled.StateHoliday, filled.Customers) == (0, "b", 6.0)
    assert rows[-1].Customers == 0.0 and sum(r.InPromo2 for r in rows) == 1
    total = imputation.null_counts(imputation.impute(df)).agg(F.sum("nulls")).first()[0]
    assert total == 0


def test_mode_ties_and_all_null_columns(spark):
    df = spark.createDataFrame([(10, None), (9, None), (None, None)], "Promo int, StateHoliday string")
    assert sorted(r.Promo for r in imputation.fill_binary_mode(df).collect()) == [9, 9, 10]
    assert {r.StateHoliday for r in imputation.fill_category_mode(df).collect()} == {"Unknown"}
