"""Features that look at other rows of the same store.

Everything is a window partitioned by Store and ordered by the day number, so one hash exchange and one sort
serve all of them. (Store, Date) is unique after cleaning: a window never holds more rows than there are days,
however large the table is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daybook.config import DEFAULT_CONFIG
from daybook.functions import calendar

NO_PROMO_DAYS = 999
DAY = "__day"


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn(DAY, F.unix_date("Date"))


def by_day() -> WindowSpec:
    return Window.partitionBy("Store").orderBy(DAY)


def so_far() -> WindowSpec:
    return by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)


# --- promotions -------------------------------------------------------------------------------------------


def last_promo_date() -> Column:
    """Latest promotion date up to and including the row's own date (an as-of lookup without a join)."""
    upto = by_day().rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return F.max(F.when(F.col("Promo") == 1, F.col("Date"))).over(upto)


def promo_changed() -> Column:
    return F.coalesce(F.col("Promo") != F.lag("Promo").over(by_day()), F.lit(True)).cast("int")


def promo_sequence(changed: Column) -> Column:
    """Run number within the store, from a column holding `promo_changed`."""
    return F.sum(changed).over(so_far()).cast("int")


def promo_sequence_length(changed: Column, row_number: Column) -> Column:
    """1-based position inside the current promotion run, 0 outside promotions."""
    run_start = F.max(F.when(changed == 1, row_number)).over(so_far())
    return F.when(F.col("Promo") == 1, row_number - run_start + 1).otherwise(0).cast("int")


def days_since_last_promo() -> Column:
    return F.when(F.col("Promo") == 1, F.lit(0)).otherwise(
        F.coalesce(F.datediff(F.col("Date"), last_promo_date()), F.lit(NO_PROMO_DAYS))
    )


def promo_edges() -> dict[str, Column]:
    previous = F.lag("Promo").over(by_day())
    return {
        "IsPromoStart": calendar.flag((F.col("Promo") == 1) & (previous == 0)),
        "IsPromoEnd": calendar.flag((F.col("Promo") == 0) & (previous == 1)),
    }


def promo_features(df: DataFrame) -> DataFrame:
    staged = with_day(df).withColumns({
        "__changed": promo_changed(),
        "__row": F.row_number().over(by_day()),
        "DaysSinceLastPromo": days_since_last_promo(),
        **promo_edges(),
    })
    return staged.withColumns({
        "PromoSequence": promo_sequence(F.col("__changed")),
        "PromoSequenceLength": promo_sequence_length(F.col("__changed"), F.col("__row")),
    }).drop("__changed", "__row", DAY)


# --- holidays: neighbours by row, not by calendar day -----------------------------------------------------


def holiday_neighbours(holiday: Column) -> dict[str, Column]:
    return {
        "WasHolidayYesterday": F.lag(holiday, 1, 0).over(by_day()),
        "IsHolidayTomorrow": F.lead(holiday, 1, 0).over(by_day()),
    }


def holiday_last_week(holiday: Column) -> Column:
    return F.coalesce(F.max(holiday).over(by_day().rowsBetween(-7, -1)), F.lit(0))


def holiday_features(df: DataFrame) -> DataFrame:
    holiday = calendar.is_holiday(F.col("StateHoliday"))
    return with_day(df).withColumns({
        **calendar.holiday_codes(F.col("StateHoliday")),
        **holiday_neighbours(holiday),
        "WasHolidayLastWeek": holiday_last_week(holiday),
    }).drop(DAY)


# --- calendar-exact lags and rolling statistics -----------------------------------------------------------

LAG_FAMILIES = ("SalesLag", "RollingMean", "RollingStd", "RollingMin", "RollingMax")


def lag_columns(lags: Sequence[int] = DEFAULT_CONFIG.lag_days) -> list[str]:
    return [f"{family}_{k}" for k in lags for family in LAG_FAMILIES]


def sales_lag(k: int, value: str = "Sales") -> Column:
    """Sales exactly k days earlier; NULL when that day is missing."""
    return F.max(value).over(by_day().rangeBetween(-k, -k))


def rolling_stats(k: int, value: str = "Sales") -> dict[str, Column]:
    """Mean / sample deviation / min / max over the days [D-k, D-1], missing days skipped."""
    if k == 1:
        # A one-day frame: every statistic is that day's value and the sample deviation is undefined.
        only = sales_lag(1, value)
        return {
            "RollingMean_1": only.cast("double"),
            "RollingStd_1": F.lit(None).cast("double"),
            "RollingMin_1": only,
            "RollingMax_1": only,
        }
    frame = by_day().rangeBetween(-k, -1)
    return {
        f"RollingMean_{k}": F.avg(value).over(frame),
        f"RollingStd_{k}": F.stddev_samp(value).over(frame),
        f"RollingMin_{k}": F.min(value).over(frame),
        f"RollingMax_{k}": F.max(value).over(frame),
    }


def lag_expressions(lags: Sequence[int] = DEFAULT_CONFIG.lag_days, value: str = "Sales") -> dict[str, Column]:
    out: dict[str, Column] = {}
    for k in lags:
        out[f"SalesLag_{k}"] = sales_lag(k, value)
        out.update(rolling_stats(k, value))
    return out


def raw_lags(df: DataFrame, lags: Sequence[int] = DEFAULT_CONFIG.lag_days) -> DataFrame:
    return with_day(df).withColumns(lag_expressions(lags)).drop(DAY)


def expanding_fill_expressions(columns: Sequence[str]) -> dict[str, Column]:
    """Fill a lag column's nulls from its own earlier values in the store, then with 0."""
    out: dict[str, Column] = {}
    for name in columns:
        c = F.col(name)
        if name == "RollingStd_1":  # always undefined, so there is nothing to expand
            out[name] = F.coalesce(c, F.lit(0.0))
            continue
        statistic = {
            "SalesLag": F.avg,
            "RollingMean": F.avg,
            "RollingStd": F.stddev_samp,
            "RollingMin": F.min,
            "RollingMax": F.max,
        }[name.rsplit("_", 1)[0]]
        out[name] = F.coalesce(c.cast("double"), statistic(c).over(so_far()), F.lit(0.0))
    return out


def expanding_fill(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = [c for c in df.columns if c.rsplit("_", 1)[0] in LAG_FAMILIES] if columns is None else columns
    return with_day(df).withColumns(expanding_fill_expressions(columns)).drop(DAY)


def lag_features(df: DataFrame, lags: Sequence[int] = DEFAULT_CONFIG.lag_days) -> DataFrame:
    staged = with_day(df).withColumns(lag_expressions(lags))
    return staged.withColumns(expanding_fill_expressions(lag_columns(lags))).drop(DAY)


def history_reach(lags: Sequence[int] = DEFAULT_CONFIG.lag_days) -> int:
    """Days of history before a requested day that its lags and fills can look at."""
    return 2 * max(lags) + 30


def history_since(requests: DataFrame, lags: Sequence[int] = DEFAULT_CONFIG.lag_days):
    """First day of history that any request needs; None without requests."""
    return requests.agg(F.date_sub(F.min("Date"), history_reach(lags))).first()[0]


def batch_lags(
    requests: DataFrame, history: DataFrame, lags: Sequence[int] = DEFAULT_CONFIG.lag_days, unique: bool = False
) -> DataFrame:
    """Lags for arbitrary (Store, Date) requests against the history table, with the requests' other columns.

    Requests join the history as rows without a value; every frame ends the day before, so a history row of the
    requested day never leaks. History is cut to the days the frames can reach. With `unique` the caller vouches
    that no pair repeats and everything runs in one exchange by Store; otherwise equal pairs are computed once
    (a pair may repeat without bound) and fan out in a final join. Pass a history cut by `Warehouse.load_history(since)`
    with `history_since` to leave out whole months.
    """
    if not unique:
        keys = requests.select("Store", "Date").distinct()
        return join_lags_back(requests, batch_lags(keys, history, lags, unique=True))

    reach = history_reach(lags)
    first_day = requests.agg(F.date_sub(F.min("Date"), reach)).scalar()
    past = history.where(F.col("Date") >= first_day)
    past = past.join(requests.select("Store").distinct(), "Store", "left_semi")  # the planner sends a small side to all tasks
    past = past.select("Store", "Date", F.col("Sales").cast("double").alias("__value"), F.lit(False).alias("__ask"))
    asked = requests.withColumns({"__value": F.lit(None).cast("double"), "__ask": F.lit(True)})

    whole = by_day().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tagged = with_day(asked.unionByName(past, allowMissingColumns=True))
    since = F.date_sub(F.min(F.when(F.col("__ask"), F.col("Date"))).over(whole), reach)
    near = tagged.withColumn("__since", since).where(F.col("__ask") | (F.col("Date") >= F.col("__since")))
    lagged = near.withColumns(lag_expressions(lags, "__value")).where("__ask")
    return lagged.select(*requests.columns, *lag_columns(lags))


def join_lags_back(df: DataFrame, lags: DataFrame) -> DataFrame:
    """Left equi-join on (Store, Date); repeated request pairs stay repeated."""
    return df.join(lags, ["Store", "Date"], "left")


def full_calendar(df: DataFrame, per_store: bool = False) -> DataFrame:
    """Every store on every day between the first and the last date, left-joined with the rows present."""
    if per_store:
        spans = df.groupBy("Store").agg(F.min("Date").alias("lo"), F.max("Date").alias("hi"))
    else:
        bounds = df.agg(F.struct(F.min("Date").alias("lo"), F.max("Date").alias("hi")).alias("b")).scalar()
        spans = df.select("Store").distinct().select("Store", bounds["lo"].alias("lo"), bounds["hi"].alias("hi"))
    days = spans.select("Store", F.explode(F.sequence("lo", "hi")).alias("Date"))
    return days.join(df, ["Store", "Date"], "left")
