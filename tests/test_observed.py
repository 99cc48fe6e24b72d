from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from daybook.operators.observed import Steps
from daybook.plans import jobs

RAW = "Store string, Date string, Sales string, Open string, Promo string, seq long"


def raw(spark):
    rows = [("1", "2024-01-01", "5", "1", "0", 1), ("1", "2024-01-01", "7", "1", "0", 2), ("1", "bad", "3", "1", "1", 3),
            ("2", "2024-01-01", "4", "0", "1", 4), ("2", "2024-01-02", "0", "1", None, 5), ("3", "2024-01-02", "9", "1", "0", 6)]
    return spark.createDataFrame(rows, RAW)


def test_steps_report_removed_rows_from_the_writing_pass(spark, root):
    steps = Steps()
    cleaned = jobs.clean_job(raw(spark), ["seq"], check_fractions=False, steps=steps)
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CollectMetrics") == 5 and plan.count("LogicalRDD") == 1  # one scan
    cleaned.write.parquet(f"{root}/cleaned")
    got = [(r.step, r.rows, r.removed) for r in steps.removed(spark).orderBy("number").collect()]
    assert got == [("read", 6, 0), ("unique", 5, 1), ("dated", 4, 1), ("open", 3, 1), ("positive", 2, 1)]
    assert sorted(r.Sales for r in spark.read.parquet(f"{root}/cleaned").collect()) == [7.0, 9.0]


def test_steps_count_nulls_and_refuse_a_name_twice(spark):
    steps = Steps()
    df = steps.at("a", raw(spark), ["Promo", "Store"])
    with pytest.raises(ValueError):
        steps.at("a", df)
    steps.at("b", df.where(F.col("Promo").isNotNull()), ["Promo"]).write.format("noop").mode("overwrite").save()
    assert {(r.step, r.column): r.nulls for r in steps.nulls(spark).collect()} == {("a", "Promo"): 1, ("a", "Store"): 0, ("b", "Promo"): 0}
