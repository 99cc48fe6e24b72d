from __future__ import annotations

import os

import pytest

from daybook.operators import cleaning
from daybook.sources import files

HEADER = "Store,DayOfWeek,Date,Sales,Open,Promo,StateHoliday\n"


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_scan_sales_keeps_text_and_input_order(spark, root):
    path = write(f"{root}/train.csv", HEADER + "1,1,2024-01-01,10,1,0,0\n1,1,2024-01-01,x,1,0,a\n1,1,2024-01-01,30,1,0,0\n")
    df = files.scan_sales(spark, path)
    assert dict(df.dtypes)["StateHoliday"] == "string"
    assert [r.Sales for r in cleaning.dedupe_keep_last(df, [files.INGEST_SEQ]).collect()] == ["30"]


def test_scan_sales_accepts_any_column_order(spark, root):
    path = write(f"{root}/train.csv", "Sales,Promo,Extra,Date,Open,Store,DayOfWeek\n5,1,z,2024-01-01,1,7,3\n")
    row = files.scan_sales(spark, path).first()
    assert (row.Store, row.Sales, row.Extra) == ("7", "5", "z")


def test_scan_errors(spark, root):
    with pytest.raises(FileNotFoundError):
        files.scan_sales(spark, f"{root}/none.csv")
    with pytest.raises(ValueError, match="empty"):
        files.scan_sales(spark, write(f"{root}/empty.csv", ""))
    with pytest.raises(ValueError, match="Promo"):
        files.scan_sales(spark, write(f"{root}/short.csv", "Store,DayOfWeek,Date,Sales,Open\n1,1,2024-01-01,1,1\n"))
    with pytest.raises(ValueError, match="Assortment"):
        files.scan_store(spark, write(f"{root}/store.csv", "Store,StoreType\n1,a\n"))


def test_scan_store_types(spark, root):
    path = write(f"{root}/store.csv", "Store,StoreType,Assortment,CompetitionDistance,Promo2\n1,a,c,,1\n2,b,a,570.0,0\n")
    df = files.scan_store(spark, path)
    assert {"Store": "int", "CompetitionDistance": "double", "Promo2": "int"}.items() <= dict(df.dtypes).items()
    assert df.where("CompetitionDistance is null").count() == 1


def test_stage_checks(spark, root):
    with pytest.raises(FileNotFoundError):
        files.scan_stage(spark, f"{root}/none")
    files.sink_stage(spark.createDataFrame([], "Sales double"), f"{root}/empty")
    with pytest.raises(ValueError):
        files.scan_stage(spark, f"{root}/empty")
    files.sink_stage(spark.range(2), f"{root}/other")
    with pytest.raises(ValueError):
        files.scan_stage(spark, f"{root}/other")


def test_report_sink_leaves_failed_models_to_csv(spark, root):
    df = spark.createDataFrame([("a", 1.0, None), ("b", None, "boom")], "model string, MAPE double, error string")
    files.report_sink(df, f"{root}/json")
    files.report_sink(df, f"{root}/csv", "csv")
    assert spark.read.json(f"{root}/json").count() == 1
    assert spark.read.option("header", True).csv(f"{root}/csv").count() == 2


def test_inventory_and_gates(spark, root):
    a, b = write(f"{root}/a", "x"), write(f"{root}/b", "xyz")
    os.utime(a, (1_600_000_000, 1_600_000_000))
    rows = {r.name: r for r in files.file_inventory(spark, {"a": a, "b": b, "c": f"{root}/c"}).collect()}
    assert (rows["b"].exists, rows["b"].size, rows["c"].exists, rows["c"].size) == (True, 3, False, 0)
    assert files.freshness_gate(spark, b) and not files.freshness_gate(spark, a) and not files.freshness_gate(spark, f"{root}/c")
    assert files.retrain_gate(spark, a, b) and not files.retrain_gate(spark, b, a)
    assert files.retrain_gate(spark, f"{root}/c", b) and files.retrain_gate(spark, b, f"{root}/c")
