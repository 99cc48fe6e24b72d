"""Dimension joins and membership filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_store_dim(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Left equi-join. No broadcast hint: the planner broadcasts the dimension while its measured size allows,
    otherwise it sorts and merges, and adaptive execution splits a store that is too large."""
    return sales.join(stores, "Store", "left")


def unmatched_stores(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Fact stores that the dimension does not know. De-duplicated first, so the join sees one row per store."""
    return sales.select("Store").distinct().join(stores.select("Store"), "Store", "left_anti")


def asof_last_promo(df: DataFrame) -> DataFrame:
    """Latest promotion date on or before each non-promotion row of the same store."""
    from daybook.operators import panel

    return (
        panel.with_day(df)
        .withColumn("LastPromoDate", panel.last_promo_date())
        .where(F.col("Promo") != 1)
        .drop(panel.DAY)
    )


def period_membership(df: DataFrame, periods: DataFrame, key: Column, period_column: str = "WeekKey") -> DataFrame:
    """Rows whose period key is in the list."""
    return df.withColumn("__key", key).join(
        periods.select(F.col(period_column).alias("__key")), "__key", "left_semi"
    ).drop("__key")


def concat(*frames: DataFrame) -> DataFrame:
    """Stacks frames by column name; columns a frame lacks become NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def canonical_sort(df: DataFrame) -> DataFrame:
    """Total order by (Store, Date): a range exchange and a sort per partition. Only for sinks that need it."""
    return df.orderBy("Store", "Date")
