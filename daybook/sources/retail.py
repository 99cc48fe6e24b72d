"""Store-day inputs derived from order-line tables (`lineitem`, `supplier`, `nation`, `orders`, `events`).

A supplier, or the nation of a supplier, plays the store; the ship date is the day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import calendar
from daybook.operators import panel as windows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def state_holiday(date: Column) -> Column:
    month, day = F.month(date), F.dayofmonth(date)
    return (
        F.when((month == 12) & day.isin(25, 26), "c")
        .when(((month == 5) & (day == 1)) | ((month == 10) & (day == 3)), "a")
        .when((month == 4) & (day == 10), "b")
        .otherwise("0")
    )


def school_holiday(date: Column) -> Column:
    return F.month(date).isin(7, 8).cast("int")


def _lines(spark: SparkSession, sf_dir: str, store: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    if store == "supplier":
        return lines.withColumn("Store", F.col("l_suppkey").cast("int"))
    # No hint: the planner broadcasts the dimension while its measured size allows it.
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("int").alias("Store"))
    return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))


def sales_panel(spark: SparkSession, sf_dir: str, store: str = "supplier") -> DataFrame:
    """Clean store-day fact, unique on (Store, Date)."""
    days = (
        _lines(spark, sf_dir, store)
        .groupBy("Store", F.to_date("l_shipdate").alias("Date"))
        .agg(
            F.sum(F.round("l_extendedprice").cast("bigint")).cast("double").alias("Sales"),
            F.count(F.lit(1)).cast("int").alias("Customers"),
            F.max(F.when(F.col("l_discount") >= 0.08, 1).otherwise(0)).alias("Promo"),
        )
    )
    date = F.col("Date")
    return days.withColumns({
        "Open": F.lit(1),
        "DayOfWeek": calendar.iso_weekday(date),
        "StateHoliday": state_holiday(date),
        "SchoolHoliday": school_holiday(date),
    })


SEQUENCE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty text fact: repeated (Store, Date), closed and zero-sales rows, bad dates, bad numbers.

    `ingest_seq` is the total order that stands for the input order.
    """
    day = F.to_date("l_shipdate")
    quantity = F.col("l_quantity")
    return _lines(spark, sf_dir, "nation").select(
        F.col("Store").cast("string").alias("Store"),
        F.when(quantity == 2, "invalid-date").otherwise(day.cast("string")).alias("Date"),
        F.when(quantity == 1, "0")
        .when(quantity == 3, "n/a")
        .otherwise(F.round("l_extendedprice").cast("bigint").cast("string"))
        .alias("Sales"),
        F.when(F.col("l_linenumber") == 6, None).otherwise(quantity.cast("bigint").cast("string")).alias("Customers"),
        F.when(F.col("l_linenumber") == 7, "0").otherwise("1").alias("Open"),
        F.when(F.col("l_discount") >= 0.08, "1.0").otherwise("0").alias("Promo"),
        calendar.iso_weekday(day).cast("string").alias("DayOfWeek"),
        state_holiday(day).alias("StateHoliday"),
        F.when(quantity == 4, None).otherwise(school_holiday(day).cast("string")).alias("SchoolHoliday"),
        F.struct(*SEQUENCE).alias("ingest_seq"),
    )


def store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store dimension over nations, with the gaps a real one has."""
    key, region = F.col("n_nationkey"), F.col("n_regionkey")
    known, promo2 = key % 5 != 0, key % 2 == 0
    return table(spark, sf_dir, "nation").select(
        key.cast("int").alias("Store"),
        F.element_at(F.array(*[F.lit(c) for c in "abcd"]), (key % 4 + 1).cast("int")).alias("StoreType"),
        F.element_at(F.array(*[F.lit(c) for c in "abc"]), (region % 3 + 1).cast("int")).alias("Assortment"),
        F.when(key % 6 != 5, (key * 700 + 150).cast("double")).alias("CompetitionDistance"),
        F.when(known, (key % 12 + 1).cast("double")).alias("CompetitionOpenSinceMonth"),
        F.when(known, (key % 9 + 1992).cast("double")).alias("CompetitionOpenSinceYear"),
        promo2.cast("int").alias("Promo2"),
        F.when(promo2, (key + 1).cast("double")).alias("Promo2SinceWeek"),
        F.when(promo2, F.lit(1996.0)).alias("Promo2SinceYear"),
        F.when(promo2, F.lit("Jan,Apr,Jul,Oct")).alias("PromoInterval"),
    )


def merged_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_panel(spark, sf_dir, "nation").join(store_dim(spark, sf_dir), "Store", "left")


def predictions(spark: SparkSession, sf_dir: str, window: int = 7, store: str = "nation") -> DataFrame:
    """Forecast of every panel row by its rolling mean (0 without a past), with the actual value."""
    mean = F.avg("Sales").over(windows.by_day().rangeBetween(-window, -1))
    rows = windows.with_day(sales_panel(spark, sf_dir, store))
    return rows.select(
        "Store", "Date", F.coalesce(mean, F.lit(0.0)).alias("PredictedSales"), F.col("Sales").alias("ActualSales")
    )


def prediction_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored prediction runs in the durable layout (without the errors a reader may derive)."""

    def run(name: str, window: int, created: str) -> DataFrame:
        return predictions(spark, sf_dir, window).select(
            F.lit(name).alias("run_id"),
            F.col("Store").alias("store_id"),
            F.col("Date").alias("date"),
            F.col("PredictedSales").alias("predicted_sales"),
            F.col("ActualSales").alias("actual_sales"),
            F.abs(F.col("ActualSales") - F.col("PredictedSales")).alias("absolute_error"),
            (F.abs(F.col("ActualSales") - F.col("PredictedSales")) / F.col("ActualSales") * 100).alias("percentage_error"),
            F.lit(created).cast("timestamp").alias("created_at"),
        )

    return run("run_a", 7, "2024-01-01 02:00:00").unionByName(run("run_b", 28, "2024-01-02 02:00:00"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job run per order: the status, length and size come from the order."""
    price = F.col("o_totalprice")
    # Without a time zone, so that the session's does not matter.
    started = F.to_date("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.col("o_orderkey") % 86400).cast("decimal(18,6)")
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run_"), F.col("o_orderkey")).alias("run_id"),
        F.col("o_orderpriority").alias("dag_name"),
        F.when(F.col("o_orderstatus") == "F", "failure").otherwise("success").alias("status"),
        started.alias("started_at"),
        F.floor(price / 1000).cast("double").alias("duration_seconds"),
        F.floor(price).cast("bigint").alias("records_processed"),
        F.when(F.col("o_orderstatus") == "F", None).otherwise(F.floor(price) % 4000 / 100).cast("double").alias("mape"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("order "), F.col("o_orderkey"))).alias("error_message"),
    )
