from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from daybook.operators import joins, panel
from daybook.plans.features import align_features, build_features, feature_names

DAY = dt.date(2024, 1, 1)


def frame(spark, rows, schema="Store int, Date date, Sales double, Promo int"):
    return spark.createDataFrame(rows, schema)


def days(*offsets):
    return [DAY + dt.timedelta(days=o) for o in offsets]


def test_hand_checked_lags_and_fills(spark):
    df = frame(spark, [(1, d, float(v), 0) for d, v in zip(days(0, 1, 3, 8), (10, 20, 40, 90))])
    raw = panel.raw_lags(df).orderBy("Date").toPandas()
    assert raw["SalesLag_1"].tolist()[1] == 10 and raw["SalesLag_1"].isna().tolist() == [True, False, True, True]
    assert raw["SalesLag_7"].isna().tolist() == [True, True, True, False] and raw["SalesLag_7"].iloc[3] == 20
    assert raw["RollingMean_7"].tolist()[1:] == [10, 15, 30]
    assert np.allclose(raw["RollingStd_7"].tolist()[2:], [7.0711, 14.1421], atol=1e-4)
    filled = panel.lag_features(df).orderBy("Date").toPandas()
    assert filled["SalesLag_1"].tolist() == [0, 10, 10, 10]
    assert filled["SalesLag_7"].tolist() == [0, 0, 0, 20]
    assert filled["RollingMean_7"].tolist() == [0, 10, 15, 30]
    assert filled["RollingMax_7"].tolist() == [0, 10, 20, 40]
    assert filled["RollingStd_1"].tolist() == [0, 0, 0, 0]


def random_panel(spark, seed=0, stores=4, span=90):
    rng = np.random.default_rng(seed)
    rows = [
        (s, DAY + dt.timedelta(days=int(d)), float(rng.integers(1, 100)), int(rng.random() < 0.3))
        for s in range(1, stores + 1) for d in np.flatnonzero(rng.random(span) < 0.6)
    ]
    return rows, frame(spark, rows)


def test_lags_match_a_dense_calendar(spark):
    rows, df = random_panel(spark)
    pdf = pd.DataFrame(rows, columns=["Store", "Date", "Sales", "Promo"])
    got = panel.raw_lags(df).toPandas().set_index(["Store", "Date"]).sort_index()
    for store, part in pdf.groupby("Store"):
        series = part.set_index(pd.to_datetime(part["Date"]))["Sales"].asfreq("D")
        for k in (1, 7, 14, 28):
            window = series.shift(1).rolling(k, min_periods=1)
            for name, want in (
                ("SalesLag", series.shift(k)), ("RollingMean", window.mean()), ("RollingStd", window.std()),
                ("RollingMin", window.min()), ("RollingMax", window.max()),
            ):
                have = got.loc[store][f"{name}_{k}"]
                expected = want.loc[pd.to_datetime(have.index)]
                assert np.allclose(have.astype(float), expected, equal_nan=True), (store, name, k)


def test_rolling_bounds(spark):
    _, df = random_panel(spark, 3)
    bad = panel.raw_lags(df).where("RollingMin_14 > RollingMean_14 + 1e-9 or RollingMean_14 > RollingMax_14 + 1e-9")
    assert bad.count() == 0


def test_batch_lags_equal_panel_lags(spark):
    _, df = random_panel(spark, 5)
    columns = ["Store", "Date", *panel.lag_columns()]
    ours = panel.batch_lags(df.select("Store", "Date"), df).select(columns)
    theirs = panel.raw_lags(df).select(columns)
    assert ours.count() == df.count() and ours.exceptAll(theirs).count() == 0


def test_batch_lags_keep_repeats_unknown_stores_and_future_days(spark):
    _, df = random_panel(spark, 5)
    last = df.where("Store = 1").agg(F.max("Date")).first()[0]
    ask = frame(spark, [(1, last + dt.timedelta(days=1))] * 2 + [(99, last)], "Store int, Date date")
    rows = panel.batch_lags(ask, df).orderBy("Store").collect()
    assert len(rows) == 3 and rows[0].SalesLag_1 is not None and rows[2].RollingMean_28 is None
    empty = panel.batch_lags(ask, df.limit(0))
    assert empty.count() == 3 and empty.where("RollingMean_28 is not null").count() == 0


def test_promo_features(spark):
    promos = {1: (1, 1, 0, 0), 2: (1, 0, 1, 0)}
    df = frame(spark, [(s, DAY + dt.timedelta(days=i), 1.0, p) for s, ps in promos.items() for i, p in enumerate(ps)])
    out = panel.promo_features(df).orderBy("Store", "Date").toPandas()
    assert out["PromoSequence"].tolist() == [1, 1, 2, 2, 1, 2, 3, 4]
    assert out["PromoSequenceLength"].tolist() == [1, 2, 0, 0, 1, 0, 1, 0]
    assert out["DaysSinceLastPromo"].tolist() == [0, 0, 1, 2, 0, 1, 0, 1]
    assert out["IsPromoStart"].tolist() == [0, 0, 0, 0, 0, 0, 1, 0]
    assert out["IsPromoEnd"].tolist() == [0, 0, 1, 0, 0, 1, 0, 1]
    none = panel.promo_features(frame(spark, [(1, DAY, 1.0, 0)])).first()
    assert none.DaysSinceLastPromo == panel.NO_PROMO_DAYS


def test_holiday_features_go_by_row(spark):
    rows = [(1, DAY + dt.timedelta(days=3 * i), 1.0, 0, c) for i, c in enumerate("0abc0a")]
    out = panel.holiday_features(frame(spark, rows, "Store int, Date date, Sales double, Promo int, StateHoliday string"))
    out = out.orderBy("Date").toPandas()
    assert (out["IsHoliday"].sum(), out["IsPublicHoliday"].sum(), out["IsEaster"].sum(), out["IsChristmas"].sum()) == (4, 2, 1, 1)
    assert out["WasHolidayYesterday"].tolist() == [0, 0, 1, 1, 1, 0]
    assert out["IsHolidayTomorrow"].tolist() == [1, 1, 1, 0, 1, 0]
    assert out["WasHolidayLastWeek"].tolist() == [0, 0, 1, 1, 1, 1]


def test_full_calendar(spark):
    df = frame(spark, [(1, d, 1.0, 0) for d in days(0, 4)] + [(2, days(2)[0], 1.0, 0)])
    assert panel.full_calendar(df).count() == 10
    assert panel.full_calendar(df, per_store=True).count() == 6
    assert panel.full_calendar(df).where("Sales is null").count() == 7


FULL = (
    "Store int, Date date, Sales double, Customers double, Open int, DayOfWeek int, Promo int, StateHoliday string, "
    "SchoolHoliday int, StoreType string, Assortment string, CompetitionDistance double, CompetitionOpenSinceMonth double, "
    "CompetitionOpenSinceYear double, Promo2 int, Promo2SinceWeek double, Promo2SinceYear double, PromoInterval string"
)


def full(spark, change=None):
    rows = []
    for store in (1, 2):
        for n, d in enumerate(days(*range(30))):
            value = 100.0 * store + n + (1000.0 if change == (store, n) else 0)
            gap = store == 2
            rows.append((
                store, d, value, None if n == 3 else 5.0, 1, d.isoweekday(), n % 2, "a" if n == 5 else "0", 0, "a", "c",
                None if gap else 500.0, None if gap else 3.0, None if gap else 2010.0, 1, None if gap else 5.0,
                None if gap else 2011.0, None if gap else "Jan,Apr",
            ))
    return frame(spark, rows, FULL)


def test_feature_table_contract(spark):
    out = build_features(full(spark))
    names = feature_names()
    assert len(names) == len(set(names)) == 78
    assert out.columns == [*names, "Sales", "Date"]
    assert out.count() == 60
    assert out.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in names]).first().asDict().items() >= {c: 0 for c in names}.items()
    row = out.where("Store = 2").first()
    assert row.CompetitionOpen == 1 and row.CompetitionOpenMonths > 20000 and row.CompetitionFar == 1


def test_todays_sales_leak_into_no_feature(spark):
    names = [n for n in feature_names()]
    day = days(20)[0]
    a = build_features(full(spark)).where((F.col("Store") == 1) & (F.col("Date") == F.lit(day))).select(names).first()
    b = build_features(full(spark, (1, 20))).where((F.col("Store") == 1) & (F.col("Date") == F.lit(day))).select(names).first()
    assert a == b


def test_feature_plan_has_one_exchange(spark):
    source = full(spark)
    plan = build_features(source, imputed=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_feature_input_is_validated(spark):
    with pytest.raises(ValueError):
        build_features(full(spark).drop("Promo"))
    with pytest.raises(ValueError):
        build_features(full(spark).withColumn("Date", F.col("Date").cast("string")))


def test_empty_and_one_row_input(spark):
    assert build_features(full(spark).limit(0)).count() == 0
    assert build_features(full(spark).limit(1)).count() == 1


def test_align_features(spark):
    df = frame(spark, [(1, DAY, 5.0, 1)])
    out = align_features(df, ["Promo", "Missing"])
    assert out.columns == ["Promo", "Missing", "Date", "Sales"] and out.first()["Missing"] is None
    assert align_features(df, None).columns == df.columns


def test_asof_and_dimension_joins(spark):
    df = frame(spark, [(1, d, 1.0, p) for d, p in zip(days(0, 1, 5), (1, 0, 0))] + [(3, DAY, 1.0, 0)])
    out = joins.asof_last_promo(df).orderBy("Store", "Date").collect()
    assert [r.LastPromoDate for r in out] == [DAY, DAY, None]
    stores = frame(spark, [(1, "a")], "Store int, StoreType string")
    assert joins.join_store_dim(df, stores).where("StoreType is null").count() == 1
    assert [r.Store for r in joins.unmatched_stores(df, stores).collect()] == [3]
