"""Sales history: merge, slices, retention and statistics (CamelCase columns)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators import cleaning
from daybook.schemas import REQUIRED_HISTORY, require_columns


def last_per_day(new: DataFrame, order_by: str | None = None) -> DataFrame:
    """The history columns, one row per (Store, Date): the last by `order_by`."""
    require_columns(new.columns, REQUIRED_HISTORY, "new history rows")
    seq = F.col(order_by) if order_by else F.lit(0)
    return cleaning.dedupe_keep_last(new.select(*REQUIRED_HISTORY, seq.alias("__seq")), ["__seq"]).drop("__seq")


def merge_history(history: DataFrame, new: DataFrame, order_by: str | None = None) -> DataFrame:
    """History and new rows, the new row winning on (Store, Date); among new rows the last by `order_by`.

    Both rules are one ordering, so the merge is a single exchange on (Store, Date).
    """
    require_columns(new.columns, REQUIRED_HISTORY, "new history rows")
    seq = F.col(order_by) if order_by else F.lit(0)
    incoming = new.select(*REQUIRED_HISTORY, F.lit(1).alias("__new"), seq.alias("__seq"))
    stored = history.select(*REQUIRED_HISTORY, F.lit(0).alias("__new"), F.lit(None).alias("__seq"))
    newest = cleaning.dedupe_keep_last(stored.unionByName(incoming), ["__new", "__seq"])
    return newest.drop("__new", "__seq")


def store_history_slice(
    history: DataFrame, store: int, days_back: int = 365, end: date | str | None = None
) -> DataFrame:
    """One store's rows in [end - days_back, end]; `end` defaults to the store's own last day."""
    own = history.where(F.col("Store") == store)
    last: Column = own.agg(F.max("Date")).scalar() if end is None else F.lit(end).cast("date")
    return own.where((F.col("Date") >= F.date_sub(last, days_back)) & (F.col("Date") <= last))


def retention(history: DataFrame, cutoff: date | str) -> DataFrame:
    return history.where(F.col("Date") >= F.lit(cutoff).cast("date"))


def removed_by_retention(history: DataFrame, cutoff: date | str) -> DataFrame:
    return history.agg(F.count_if(F.col("Date") < F.lit(cutoff).cast("date")).alias("removed"))


def history_stats(history: DataFrame) -> DataFrame:
    return history.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("Store").alias("unique_stores"),
        F.coalesce(F.concat(F.min("Date").cast("string"), F.lit(" - "), F.max("Date").cast("string")), F.lit("empty")).alias("date_range"),
        F.coalesce(F.datediff(F.max("Date"), F.min("Date")), F.lit(0)).alias("date_coverage_days"),
    )


def store_stats(history: DataFrame, days_back: int = 365, end: date | str | None = None) -> DataFrame:
    """Statistics of every store over its own last `days_back` days."""
    if end is None:
        # The last day travels with each row; a store has one row per day, so the window stays small.
        last = F.max("Date").over(Window.partitionBy("Store"))
    else:
        last = F.lit(end).cast("date")
    recent = history.withColumn("__last", last).where(
        (F.col("Date") >= F.date_sub(F.col("__last"), days_back)) & (F.col("Date") <= F.col("__last"))
    )
    return recent.groupBy("Store").agg(
        F.count(F.lit(1)).alias("records_count"),
        F.min("Date").alias("date_from"),
        F.max("Date").alias("date_to"),
        F.avg("Sales").alias("avg_sales"),
        F.sum("Sales").alias("total_sales"),
        F.sum("Promo").alias("promo_days"),
        F.count_if(F.coalesce(F.col("StateHoliday") != "0", F.lit(True))).alias("holiday_days"),
    )


def one_store_stats(history: DataFrame, store: int, end: date | str | None = None) -> DataFrame:
    """The same for one store; raises for a store the history does not know."""
    stats = store_stats(history.where(F.col("Store") == store), end=end)
    if stats.isEmpty():
        raise ValueError(f"store {store} is not in the history")
    return stats
