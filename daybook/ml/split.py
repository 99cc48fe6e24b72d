"""Time-ordered splits on ISO weeks.

The distinct weeks of any history are few (53 per year), so they are handled as a sorted list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import calendar

WEEK = "WeekKey"


def with_week_key(df: DataFrame) -> DataFrame:
    if WEEK in df.columns:
        return df
    if "ISOYear" in df.columns and "Week" in df.columns:
        return df.withColumn(WEEK, calendar.week_key(F.col("ISOYear"), F.col("Week")))
    return df.withColumn(WEEK, calendar.week_key(calendar.iso_year(F.col("Date")), F.weekofyear("Date")))


def week_keys(df: DataFrame) -> list[int]:
    return sorted(r[0] for r in with_week_key(df).select(WEEK).distinct().collect())


def check_ratio(ratio: float) -> None:
    if not 0.0 < ratio < 1.0:
        raise ValueError(f"the train ratio must lie in (0, 1), got {ratio}")


def pivot_week(weeks: list[int], ratio: float) -> int:
    """Last training week: the item at int(n * ratio), 0-based, so training holds int(n * ratio) + 1 weeks."""
    check_ratio(ratio)
    return weeks[int(len(weeks) * ratio)]


def label_split(df: DataFrame, ratio: float = 0.8) -> DataFrame:
    """Lazy form: adds IsTrain (1/0)."""
    check_ratio(ratio)
    keyed = with_week_key(df)
    weeks = keyed.select(WEEK).distinct()
    in_order = Window.orderBy(WEEK)  # over the distinct weeks only
    ranked = weeks.select(WEEK, (F.row_number().over(in_order) - 1).alias("i"), F.count(F.lit(1)).over(Window.partitionBy()).alias("n"))
    pivot = ranked.agg(F.max(F.when(F.col("i") == F.floor(F.col("n") * F.lit(ratio)), F.col(WEEK)))).scalar()
    return keyed.withColumn("IsTrain", (F.col(WEEK) <= pivot).cast("int"))


def time_split(df: DataFrame, ratio: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(train, test): whole weeks, every store on both sides."""
    keyed = with_week_key(df)
    weeks = week_keys(keyed)
    if not weeks:
        raise ValueError("no rows to split")
    pivot = pivot_week(weeks, ratio)
    if pivot == weeks[-1]:
        raise ValueError("the split leaves no test week")
    return keyed.where(F.col(WEEK) <= pivot), keyed.where(F.col(WEEK) > pivot)


def holdout_split(train: DataFrame, holdout_ratio: float = 0.15) -> tuple[DataFrame, DataFrame]:
    """(search, holdout): the last part of the training weeks is held out."""
    keyed = with_week_key(train)
    weeks = week_keys(keyed)
    first_held = weeks[int(len(weeks) * (1 - holdout_ratio))]
    return keyed.where(F.col(WEEK) < first_held), keyed.where(F.col(WEEK) >= first_held)


def expanding_folds(weeks: list[int], splits: int = 3) -> list[tuple[list[int], list[int]]]:
    """Consecutive validation blocks of n // (splits + 1) weeks taken from the end; training is all before."""
    size = len(weeks) // (splits + 1)
    if size == 0:
        raise ValueError(f"{len(weeks)} weeks are too few for {splits} folds")
    starts = range(len(weeks) - splits * size, len(weeks), size)
    return [(weeks[:s], weeks[s : s + size]) for s in starts]


def fold_table(df: DataFrame, splits: int = 3) -> DataFrame:
    """fold, WeekKey, role for every fold; a few hundred rows per year of history."""
    rows = []
    for fold, (train, validation) in enumerate(expanding_folds(week_keys(df), splits)):
        rows += [(fold, k, "train") for k in train] + [(fold, k, "validation") for k in validation]
    return df.sparkSession.createDataFrame(rows, f"fold int, {WEEK} int, role string")
