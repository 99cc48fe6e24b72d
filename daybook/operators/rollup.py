"""Dashboard figures from a roll-up: additive error sums per store and day, of which every filter is a sum of cells.

The roll-up is written once per prediction run, by months; the pages of the dashboard then read cells instead of predictions. Counts and sums
are exact, so the figures equal those from the rows up to rounding of doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.cleaning import filter_dashboard

MONTH = "month"
SUMS = {
    "n": "count(1)", "actual": "sum(a)", "predicted": "sum(p)", "actual_squares": "sum(a * a)", "errors": "sum(a - p)",
    "absolute": "sum(abs(a - p))", "squares": "sum((a - p) * (a - p))", "n_positive": "count_if(a > 0)",
    "percent": "coalesce(sum(if(a > 0, abs(a - p) / a * 100, 0)), 0)",
}


def roll_up(df: DataFrame) -> DataFrame:
    """One cell per store and day of the rows with both values: partial sums before the shuffle, however many rows a cell has."""
    rows = df.select("Store", "Date", F.col("ActualSales").cast("double").alias("a"), F.col("PredictedSales").cast("double").alias("p"))
    rows = rows.where("a is not null and p is not null")
    return rows.groupBy("Store", "Date").agg(*[F.expr(e).alias(n) for n, e in SUMS.items()])


def store_roll_up(df: DataFrame, path: str) -> None:
    cells = roll_up(df).withColumn(MONTH, F.date_format("Date", "yyyy-MM"))
    cells.hint("rebalance", MONTH).sortWithinPartitions(MONTH, "Store", "Date").write.mode("overwrite").partitionBy(MONTH).parquet(path)


def load_roll_up(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The cells of the days from `start` to `end`; other months are not opened."""
    cells = spark.read.parquet(path)
    for bound, sign in ((start, ">="), (end, "<=")):
        if bound is not None:
            cells = cells.where(F.expr(f"Date {sign} date '{bound}'") & F.expr(f"{MONTH} {sign} '{str(bound)[:7]}'"))
    return cells.drop(MONTH)


def _summed(cells: DataFrame, *by: str) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in SUMS]
    return cells.groupBy(*by).agg(*sums) if by else cells.agg(*sums)


def _mape() -> Column:
    return F.coalesce(F.try_divide("percent", "n_positive"), F.lit(0.0))


def metrics(cells: DataFrame, **filters: object) -> DataFrame:
    """The dashboard's figures over the cells that `filter_dashboard` keeps (all by default)."""
    kept = filter_dashboard(cells, **filters) if filters else cells
    all_ = _summed(kept).withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    mean = F.col("errors") / F.col("n")
    values = {
        "mape": _mape(), "mae": F.col("absolute") / F.col("n"), "rmse": F.sqrt(F.col("squares") / F.col("n")), "total_sales": F.col("actual"),
        "bias": mean, "std_error": F.sqrt(F.greatest(F.col("squares") / F.col("n") - mean * mean, F.lit(0.0))),
    }
    some = F.col("n") > 0
    return all_.select(*[F.when(some, F.round(v, 2)).alias(k) for k, v in values.items()], F.col("n").alias("data_points"))


def series(cells: DataFrame) -> DataFrame:
    """Chain totals per day."""
    return _summed(cells, "Date").select("Date", F.col("actual").alias("ActualSales"), F.col("predicted").alias("PredictedSales"))


def by_store(cells: DataFrame) -> DataFrame:
    """Per store: mean, deviation and total of actual, mean of predicted, MAPE."""
    n = F.col("n")
    spread = F.greatest(F.col("actual_squares") - F.col("actual") * F.col("actual") / n, F.lit(0.0))
    return _summed(cells, "Store").select(
        "Store", F.round(F.col("actual") / n, 2).alias("AvgSales"), F.round(F.sqrt(F.try_divide(spread, F.nullif(n - 1, F.lit(0)))), 2).alias("StdSales"),
        F.round("actual", 2).alias("TotalSales"), F.round(F.col("predicted") / n, 2).alias("AvgPredicted"), _mape().alias("MAPE"),
    )
