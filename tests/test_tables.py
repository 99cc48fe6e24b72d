from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.operators import history, runs
from daybook.sources.tables import ConcurrentChange, Warehouse

SCHEMA = "Store int, Date date, Sales double, DayOfWeek int, Promo int, StateHoliday string, SchoolHoliday int"


def rows(spark, *items):
    return spark.createDataFrame(
        [(s, dt.date.fromisoformat(d), v, 1, 0, "0", 0) for s, d, v in items], SCHEMA
    )


def stored(warehouse):
    return sorted((r.Store, str(r.Date), r.Sales) for r in warehouse.load_history().collect())


def test_upsert_replaces_by_key_and_is_idempotent(spark, root):
    w = Warehouse(spark, root)
    w.upsert_history(rows(spark, (1, "2024-01-01", 1000.0), (1, "2024-01-02", 1100.0)))
    new = rows(spark, (1, "2024-01-02", 1500.0), (2, "2024-03-05", 7.0))
    want = [(1, "2024-01-01", 1000.0), (1, "2024-01-02", 1500.0), (2, "2024-03-05", 7.0)]
    for _ in range(2):
        w.upsert_history(new)
        assert stored(w) == want
    assert stored(Warehouse(spark, root)) == want
    assert w.upsert_history(new.limit(0)) == 0


def test_upsert_keeps_the_last_of_repeated_new_rows(spark, root):
    w = Warehouse(spark, root)
    new = rows(spark, (1, "2024-01-01", 1.0), (1, "2024-01-01", 2.0)).withColumn("seq", F.col("Sales"))
    w.upsert_history(new, "seq")
    w.upsert_history(new, "seq")
    assert stored(w) == [(1, "2024-01-01", 2.0)]


def test_upsert_validates_columns(spark, root):
    with pytest.raises(ValueError):
        Warehouse(spark, root).upsert_history(rows(spark, (1, "2024-01-01", 1.0)).drop("Promo"))


def test_retention_drops_months_and_trims_the_border(spark, root):
    w = Warehouse(spark, root)
    w.upsert_history(rows(spark, (1, "2023-11-01", 1.0), (1, "2024-01-01", 2.0), (1, "2024-01-20", 3.0), (1, "2024-02-01", 4.0)))
    assert w.delete_history_before("2024-01-10") == 2
    assert stored(w) == [(1, "2024-01-20", 3.0), (1, "2024-02-01", 4.0)]
    assert w.delete_history_before("2020-01-01") == 0


def test_recover_applies_a_finished_side_folder_and_drops_an_unfinished_one(spark, root, monkeypatch):
    w = Warehouse(spark, root)
    w.upsert_history(rows(spark, (1, "2024-01-01", 1.0)))
    real = Warehouse._apply

    def crash(self, side):
        raise OSError("driver lost")

    monkeypatch.setattr(Warehouse, "_apply", crash)
    with pytest.raises(OSError):
        w.upsert_history(rows(spark, (1, "2024-01-01", 9.0)))
    monkeypatch.setattr(Warehouse, "_apply", real)
    spark.range(1).write.parquet(f"{root}/_pending/unfinished")
    assert stored(w) == [(1, "2024-01-01", 1.0)]
    assert w.recover() == 1
    assert stored(w) == [(1, "2024-01-01", 9.0)]
    assert w.recover() == 0


def test_month_filter_prunes_partitions(spark, root):
    w = Warehouse(spark, root)
    w.upsert_history(rows(spark, (1, "2024-01-01", 1.0), (1, "2024-02-01", 2.0)))
    plan = w.read("sales_history").where("month = '2024-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def predictions(spark, *items):
    return spark.createDataFrame(
        [(s, dt.date.fromisoformat(d), p, a) for s, d, p, a in items], "Store int, Date date, PredictedSales double, ActualSales double"
    )


def test_predictions_are_all_or_nothing_per_run(spark, root):
    w = Warehouse(spark, root)
    assert w.run_predictions().count() == 0
    w.append_predictions(predictions(spark, (1, "2024-01-01", 5.0, 4.0)), "run_1")
    w.append_predictions(predictions(spark, (1, "2024-01-01", 6.0, None), (2, "2024-01-01", 6.0, 1.0)), "run_2")
    with pytest.raises(ValueError):
        w.append_predictions(predictions(spark, (3, "2024-01-01", 6.0, None)), "run_2")
    with pytest.raises(ValueError):
        w.append_predictions(predictions(spark, (1, "2024-01-01", 6.0, 1.0), (1, "2024-01-01", 7.0, 1.0)), "run_3")
    assert w.run_predictions().count() == 2 and w.run_predictions("run_1").count() == 1
    listed = runs.list_runs(w.predictions()).collect()
    assert [(r.run_id, r.records) for r in listed] == [("run_2", 2), ("run_1", 1)]
    assert {r.table: r.records for r in w.table_counts().collect()}["predictions"] == 3


def test_run_log_keeps_the_latest_entry_per_step(spark, root):
    w = Warehouse(spark, root)
    w.log_run("run_1", "train", "failure", error_message="x")
    w.log_run("run_1", "train", "success", mape=9.5)
    w.log_run("run_1", "predict", "success", records_processed=7)
    kept = {r.dag_name: r for r in w.pipeline_runs().collect()}
    assert kept["train"].status == "success" and kept["predict"].records_processed == 7


def test_model_metrics(spark, root):
    w = Warehouse(spark, root)
    w.log_model_metrics({"MAPE": 12.74, "RMSE": 680.0, "MAE": 450.0, "R2": 0.92}, n_features=52, best_params={"num_leaves": 101})
    row = runs.recent_records(w.model_metrics(), "trained_at").first()
    assert (row.mape, row.n_features, row.best_params) == (12.74, 52, '{"num_leaves": 101}') and row.model_version.startswith("v_")


def test_backfill_skips_missing_inputs(spark, root):
    w = Warehouse(spark, root)
    w.backfill(None, predictions(spark).limit(0), None)
    assert all(r.records == 0 for r in w.table_counts().collect())
    metrics = spark.createDataFrame([(9.7, 10)], "MAPE double, Samples int")
    w.backfill(rows(spark, (1, "2024-01-01", 1.0)), predictions(spark, (1, "2024-01-01", 5.0, 4.0)), metrics)
    assert w.predictions().first().run_id == "migration_initial"
    assert w.model_metrics().first().model_version == "migration_lgbm_0"


def test_history_slices_and_statistics(spark):
    df = rows(spark, *[(1, f"2024-01-{d:02d}", float(d)) for d in range(1, 31)], (2, "2023-01-01", 5.0))
    assert history.store_history_slice(df, 1, 14).count() == 15
    assert history.store_history_slice(df, 1, 3, "2024-01-10").count() == 4
    assert history.store_history_slice(df, 9).count() == 0
    row = history.history_stats(df).first()
    assert (row.total_records, row.unique_stores, row.date_range, row.date_coverage_days) == (31, 2, "2023-01-01 - 2024-01-30", 394)
    empty = history.history_stats(df.limit(0)).first()
    assert (empty.total_records, empty.date_range, empty.date_coverage_days) == (0, "empty", 0)
    assert history.one_store_stats(df, 1).first().total_sales == 465
    with pytest.raises(ValueError):
        history.one_store_stats(df, 9)
    assert history.removed_by_retention(df, "2024-01-01").first().removed == 1


def test_history_rows_without_a_key_are_an_error(spark, root):
    warehouse = Warehouse(spark, root)
    day = "cast('2024-01-0{}' as date)"
    rows = "select {} as Store, {} as Date, 1.0D as Sales, 1 as DayOfWeek, 0 as Promo, '0' as StateHoliday, 0 as SchoolHoliday"
    for bad in (("cast(null as int)", day.format(1)), ("1", "cast(null as date)")):
        with pytest.raises(ValueError, match="null"):
            warehouse.upsert_history(spark.sql(rows.format(*bad) + " union all " + rows.format("2", day.format(2))))
    assert warehouse.load_history().count() == 0


def test_history_bounds_prune_months(spark, root):
    warehouse = Warehouse(spark, root)
    rows = spark.sql(
        "select 1 as Store, date_add(date '2024-01-01', cast(id as int)) as Date, 1.0D as Sales, 1 as DayOfWeek, 0 as Promo, "
        "'0' as StateHoliday, 0 as SchoolHoliday from range(200)"
    )
    warehouse.upsert_history(rows)
    some = warehouse.load_history("2024-02-10", "2024-03-20")
    assert some.count() == 40
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "2024-02" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_reader_sees_one_version_while_writers_work(spark, root):
    w = Warehouse(spark, root)
    w.upsert_history(rows(spark, (1, "2024-01-01", 1.0), (1, "2024-02-01", 2.0)))
    reader = w.load_history()
    w.upsert_history(rows(spark, (1, "2024-01-01", 10.0), (1, "2024-02-01", 20.0), (1, "2024-03-01", 30.0)))
    w.delete_history_before("2024-02-01")
    assert sorted(r.Sales for r in reader.collect()) == [1.0, 2.0]
    assert sorted(r.Sales for r in w.load_history().collect()) == [20.0, 30.0]
    assert w.versions() == [1, 2, 3]  # known and new months of an upsert are one change
    assert sorted(r.sales for r in w.read_history(w.snapshot(1)).collect()) == [1.0, 2.0]
    with pytest.raises(ValueError):
        w.snapshot(9)
    assert w.vacuum(keep=1) == 1 and w.versions() == [3]
    assert sorted(r.Sales for r in w.load_history().collect()) == [20.0, 30.0]


@pytest.mark.parametrize("step", ["write", "note", "commit"])
def test_a_killed_writer_leaves_old_or_new(spark, root, monkeypatch, step):
    w = Warehouse(spark, root)
    w.upsert_history(rows(spark, (1, "2024-01-01", 1.0), (1, "2024-02-01", 2.0)))
    old, new = [1.0, 2.0], [5.0, 6.0, 7.0]
    real = Warehouse._write_text

    def crash(self, file, text):
        if step == "note" or "_log/0" in file:
            if step == "commit":
                real(self, file, text)
            raise OSError("driver lost")
        real(self, file, text)

    monkeypatch.setattr(Warehouse, "_write_text", crash)
    with pytest.raises(OSError):
        w.upsert_history(rows(spark, (1, "2024-01-01", 5.0), (1, "2024-02-01", 6.0), (2, "2024-03-01", 7.0)))
    monkeypatch.setattr(Warehouse, "_write_text", real)
    assert sorted(r.Sales for r in w.load_history().collect()) == (new if step == "commit" else old)
    assert w.recover() == (1 if step == "write" else 0)
    assert sorted(r.Sales for r in w.load_history().collect()) == (old if step == "note" else new)


def test_writers_at_the_same_time_commit_one_after_the_other(spark, root):
    from concurrent.futures import ThreadPoolExecutor

    w = Warehouse(spark, root)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: w.upsert_history(rows(spark, (k, "2024-01-01", float(k)), (k, f"2024-0{k}-02", 1.0))), range(1, 5)))
    assert len(stored(w)) == 8 and [s for s in stored(w) if s[2] > 1] == [(k, "2024-01-01", float(k)) for k in range(2, 5)]


def test_a_stale_change_is_refused(spark, root):
    w = Warehouse(spark, root)
    w.upsert_history(rows(spark, (1, "2024-01-01", 1.0)))
    base = w.snapshot()
    w.upsert_history(rows(spark, (2, "2024-01-01", 2.0)))
    with pytest.raises(ConcurrentChange):
        w._change(base, None, ["2024-01"])
    w._change(base, None, ["2024-05"])  # another month: on top of the newer version
    assert len(stored(w)) == 2
