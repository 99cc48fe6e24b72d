from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daybook.operators import cleaning, evaluation, rollup
from daybook.sources import rejects

SCHEMA = "Store int, Date date, ActualSales double, PredictedSales double"


@pytest.fixture(scope="module")
def run(spark):
    rng = random.Random(3)
    rows = []
    for k in range(600):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=k % 90)
        actual = None if k % 41 == 0 else 0.0 if k % 13 == 0 else round(rng.uniform(10, 9000), 2)
        rows.append((k % 6, day, actual, None if k % 37 == 0 else round(rng.uniform(10, 9000), 2)))
    return spark.createDataFrame(rows + rows[:40], SCHEMA).cache()


def test_any_filter_is_a_sum_of_cells(spark, run, root):
    rollup.store_roll_up(run, f"{root}/cells")
    cells = rollup.load_roll_up(spark, f"{root}/cells")
    filters = [{}, {"store": 3, "preset": "all"}, {"start": "2024-01-20", "end": "2024-02-11"}, {"store": 5, "start": "2024-03-01", "end": "2024-03-09"},
               {"start": "2030-01-01", "end": "2030-01-02"}]
    for some in filters:
        got = rollup.metrics(cells, **some).first().asDict()
        want = evaluation.dashboard_metrics(cleaning.filter_dashboard(run, **some) if some else run).first().asDict()
        assert got == pytest.approx(want) if want["data_points"] else got == want
    pruned = rollup.load_roll_up(spark, f"{root}/cells", "2024-02-05", "2024-02-25")
    assert "2024-02" in pruned._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert pruned.agg(F.min("Date"), F.max("Date")).first() == (dt.date(2024, 2, 5), dt.date(2024, 2, 25))


def test_series_and_stores_from_cells(run):
    known = run.where("ActualSales is not null and PredictedSales is not null")
    cells = rollup.roll_up(run)
    got = {r.Store: r for r in rollup.by_store(cells).collect()}
    for want in evaluation.store_comparison(known).collect():
        assert got[want.Store].asDict() == pytest.approx(want.asDict(), abs=0.011)
    days = {r.Date: r.ActualSales for r in evaluation.forecast_series(known).collect()}
    assert {r.Date: r.ActualSales for r in rollup.series(cells).collect()} == pytest.approx(days)


def test_kept_and_rejected_are_all_that_was_read(spark, root):
    rows = [("1", "2024-01-01", "5"), ("x", "bad", "n/a"), ("2", "2024-02-30", "1"), ("2", "2024-02-20", "n/a"), (None, None, None), ("3", "2024-01-02", "0")]
    raw = spark.createDataFrame(rows, "Store string, Date string, Sales string").withColumn("ingest_seq", F.monotonically_increasing_id())
    kept, rejected = rejects.split_rejects(raw, f"{root}/judged")
    assert sorted(r.Store for r in kept.collect()) == ["1", "3"] and kept.columns == raw.columns
    reasons = sorted(r.reason for r in rejected.collect())
    assert reasons == ["date is no date", "sales is no number", "store is no number", "store is no number"]
    assert {r.ingest_seq for r in kept.unionByName(rejected.drop("reason")).collect()} == {r.ingest_seq for r in raw.collect()}
    assert sum(r["rows"] for r in rejects.reject_counts(spark, f"{root}/judged").collect()) == 6
