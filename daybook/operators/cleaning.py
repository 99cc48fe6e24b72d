"""Coercion, filters, de-duplication and outlier detection on the sales fact."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.quantiles import exact_percentiles
from daybook.session import materialize

NUMERIC_COLUMNS = ("Sales", "Customers", "CompetitionDistance", "Open", "Promo")
INTEGER_COLUMNS = ("Store", "DayOfWeek", "Open", "Promo", "SchoolHoliday", "Promo2")
# Numeric in the store file as well; a text read has to coerce them too.
SINCE_COLUMNS = ("CompetitionOpenSinceMonth", "CompetitionOpenSinceYear", "Promo2SinceWeek", "Promo2SinceYear")
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def to_number(column: Column) -> Column:
    """Double, NULL for text that is no number; NaN never survives."""
    number = column.try_cast("double")
    return F.when(~F.isnan(number), number)


def coerce_types(
    df: DataFrame,
    numeric: Sequence[str] = NUMERIC_COLUMNS + SINCE_COLUMNS,
    integer: Sequence[str] = INTEGER_COLUMNS,
    check_fractions: bool = True,
) -> DataFrame:
    """Numbers from text; integer columns become int unless they hold fractions.

    Deciding that needs one aggregate over the integer columns that are not integral by type already.
    With `check_fractions=False` the caller vouches that there are none.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in numeric if c in types]
    integer = [c for c in integer if c in types]
    to_parse = [c for c in dict.fromkeys([*numeric, *integer]) if not isinstance(types[c], INTEGRAL_TYPES)]
    parsed = df.withColumns({c: to_number(F.col(c)) for c in to_parse})

    open_question = [c for c in integer if c in to_parse]
    fractional: set[str] = set()
    if check_fractions and open_question:
        row = parsed.agg(
            *[F.coalesce(F.bool_or(F.col(c) != F.floor(F.col(c))), F.lit(False)).alias(c) for c in open_question]
        ).first()
        fractional = {c for c in open_question if row[c]}
    narrow = {c: F.col(c).try_cast("int") for c in integer if c not in fractional}
    return parsed.withColumns(narrow) if narrow else parsed


def coerce_dates(df: DataFrame, column: str = "Date", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Text or timestamp to DATE; rows without a valid date are dropped."""
    source = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        parsed = F.try_to_date(source, fmt)
    else:
        parsed = F.to_date(source)
    return df.withColumn(column, parsed).where(F.col(column).isNotNull())


def filter_open(df: DataFrame) -> DataFrame:
    return df.where(F.col("Open") == 1) if "Open" in df.columns else df


def filter_positive_sales(df: DataFrame) -> DataFrame:
    return df.where(F.col("Sales") > 0)


def dedupe_keep_last(df: DataFrame, order_by: Sequence[str], keys: Sequence[str] = ("Store", "Date")) -> DataFrame:
    """Last row per key in the order given by `order_by`.

    `row_number() = 1` plans a partial group limit before the shuffle, so each map task forwards at most one
    row per key and a key that holds a third of the table does not reach one reducer whole.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_by])
    return df.withColumn("__rn", F.row_number().over(newest_first)).where(F.col("__rn") == 1).drop("__rn")


PRESET_DAYS = {"7days": 7, "30days": 30, "90days": 90}


def filter_dashboard(
    df: DataFrame,
    store: int | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
    preset: str = "custom",
    today: date | None = None,
) -> DataFrame:
    """One store (0/None = all) inside a date range that is inclusive at both ends."""

    def as_date(value: date | str | None) -> date | None:
        return date.fromisoformat(value) if isinstance(value, str) else value

    if preset == "all":
        kept = df.where(F.col("Date").isNotNull())
    else:
        start, end = as_date(start), as_date(end)
        if preset in PRESET_DAYS:
            end = end or today or date.today()
            start = end - timedelta(days=PRESET_DAYS[preset])
        if start is None or end is None:
            return df.where(F.lit(False))
        kept = df.where(F.col("Date").between(F.lit(start), F.lit(end)))
    return kept.where(F.col("Store") == store) if store else kept


def detect_outliers(
    df: DataFrame, column: str = "Sales", method: str = "iqr", threshold: float = 3.0, flag: str = "IsOutlier"
) -> DataFrame:
    """Adds a boolean flag. Limits are separate for promotion and normal days when both kinds exist."""
    if method not in ("iqr", "zscore"):
        raise ValueError(f"unknown outlier method: {method}; use 'iqr' or 'zscore'")
    if column not in df.columns:
        return df.withColumn(flag, F.lit(False))

    value = F.col(column)
    df = materialize(df)  # limits first, then the rows themselves
    regime = F.lit(-1)
    narrow = df.select(*[c for c in dict.fromkeys((column, "Promo")) if c in df.columns])
    if "Promo" in df.columns:
        split = narrow.agg((F.min("Promo") != F.max("Promo")).alias("split")).scalar()
        regime = F.when(F.coalesce(split, F.lit(False)), F.when(F.col("Promo").isin(0, 1), F.col("Promo"))).otherwise(-1)
    known = narrow.withColumn("__regime", regime.cast("int")).where(F.col("__regime").isNotNull())

    # At most two groups (0 and 1, or the single -1), so the limits are always broadcastable.
    if method == "iqr":
        quartiles = exact_percentiles(known, value, (0.25, 0.75), by=("__regime",))
        q1, q3 = F.col("q")[0], F.col("q")[1]
        limits = quartiles.select(
            "__regime",
            (q1 - threshold * (q3 - q1)).alias("__low"),
            (q3 + threshold * (q3 - q1)).alias("__high"),
        )
        outside = (value < F.col("__low")) | (value > F.col("__high"))
    else:
        limits = known.groupBy("__regime").agg(F.avg(value).alias("__low"), F.stddev_samp(value).alias("__high"))
        mean, std = F.col("__low"), F.col("__high")
        outside = (std != 0) & (F.abs(F.try_divide(value - mean, std)) > threshold)
    return (
        df.withColumn("__regime", regime.cast("int"))
        .join(F.broadcast(limits), "__regime", "left")
        .withColumn(flag, F.coalesce(outside, F.lit(False)))
        .drop("__regime", "__low", "__high")
    )


def outlier_stats(df: DataFrame, column: str = "Sales", method: str = "iqr", threshold: float = 3.0) -> DataFrame:
    """One row: counts, share and the value range of normal and outlying rows."""
    flagged = materialize(detect_outliers(df, column, method, threshold).select(F.col(column).alias("v"), "IsOutlier"))
    normal, odd = F.when(~F.col("IsOutlier"), F.col("v")), F.when(F.col("IsOutlier"), F.col("v"))
    median = exact_percentiles(flagged, normal, (0.5,)).select(F.col("q")[0])
    total, hits = F.count(F.lit(1)), F.count_if(F.col("IsOutlier"))
    return flagged.agg(
        total.alias("total_records"),
        hits.alias("outliers_count"),
        F.coalesce(F.try_divide(hits * 100, total), F.lit(0.0)).alias("outliers_percentage"),
        F.lit(method).alias("method"),
        F.lit(float(threshold)).alias("threshold"),
        F.min(normal).alias("normal_min"),
        F.max(normal).alias("normal_max"),
        F.avg(normal).alias("normal_mean"),
        F.min(odd).alias("outlier_min"),
        F.max(odd).alias("outlier_max"),
        F.avg(odd).alias("outlier_mean"),
    ).withColumn("normal_median", median.scalar())
