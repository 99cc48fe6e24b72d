"""Scalar feature families over the whole panel."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from daybook.functions import calendar
from daybook.plans.catalog.base import KEYS, MERGED, PANEL, STORE_DIM, ctes, i, plain, query, r
from daybook.sources import retail


def _panel_with(spark, sf_dir, expressions):
    return plain(retail.sales_panel(spark, sf_dir, "nation").select("Store", "Date", *[c.alias(n) for n, c in expressions.items()]), 8)


def _flag(condition: str, name: str) -> str:
    return f'{i(f"case when {condition} then 1 else 0 end")} as "{name}"'


_ISO = """cast(extract(isoyear from "Date") as bigint)"""


@query("date_parts", ctes(PANEL) + f"""
select {KEYS}, {i('year("Date")')} as "Year", {i('month("Date")')} as "Month", {i('weekofyear("Date")')} as "Week",
       {_ISO} as "ISOYear", {i('day("Date")')} as "Day", {i('dayofyear("Date")')} as "DayOfYear" from panel""")
def date_parts(spark, sf_dir):
    return _panel_with(spark, sf_dir, calendar.date_parts(F.col("Date")))


@query("weekday_flags", ctes(PANEL) + f"""
select {KEYS}, {_flag('"DayOfWeek" = 6', "IsSaturday")}, {_flag('"DayOfWeek" = 7', "IsSunday")},
       {_flag('"DayOfWeek" >= 6', "IsWeekend")} from panel""")
def weekday_flags(spark, sf_dir):
    return _panel_with(spark, sf_dir, calendar.weekday_flags(F.col("DayOfWeek")))


def _wave(name: str, value: str, period: int) -> str:
    angle = f"{2 * math.pi!r} * {value} / {period}"
    return f'{r(f"sin({angle})", 8)} as "{name}_sin", {r(f"cos({angle})", 8)} as "{name}_cos"'


@query("cyclic", ctes(PANEL) + f"""
select {KEYS}, {_wave("Month", 'month("Date")', 12)}, {_wave("DayOfWeek", '"DayOfWeek"', 7)},
       {_wave("DayOfMonth", 'day("Date")', 31)} from panel""")
def cyclic(spark, sf_dir):
    return _panel_with(spark, sf_dir, calendar.cyclic(F.month("Date"), F.col("DayOfWeek"), F.dayofmonth("Date")))


@query("seasons", ctes(PANEL) + f"""
select {KEYS}, {_flag('month("Date") between 3 and 5', "IsSpring")}, {_flag('month("Date") between 6 and 8', "IsSummer")},
       {_flag('month("Date") between 9 and 11', "IsAutumn")}, {_flag('month("Date") in (12, 1, 2)', "IsWinter")} from panel""")
def seasons(spark, sf_dir):
    return _panel_with(spark, sf_dir, calendar.seasons(F.month("Date")))


@query("boundaries", ctes(PANEL) + f"""
select {KEYS}, {_flag('day("Date") <= 5', "IsMonthStart")}, {_flag('day("Date") >= 25', "IsMonthEnd")},
       {_flag('month("Date") = 1 and day("Date") <= 7', "IsYearStart")},
       {_flag('month("Date") = 12 and day("Date") >= 25', "IsYearEnd")} from panel""")
def boundaries(spark, sf_dir):
    return _panel_with(spark, sf_dir, calendar.boundaries(F.month("Date"), F.dayofmonth("Date")))


@query("holiday_codes", ctes(PANEL) + f"""
select {KEYS}, {_flag('''"StateHoliday" <> '0' ''', "IsHoliday")}, {_flag('''"StateHoliday" = 'a' ''', "IsPublicHoliday")},
       {_flag('''"StateHoliday" = 'b' ''', "IsEaster")}, {_flag('''"StateHoliday" = 'c' ''', "IsChristmas")} from panel""")
def holiday_codes(spark, sf_dir):
    return _panel_with(spark, sf_dir, calendar.holiday_codes(F.col("StateHoliday")))


@query("one_hot", ctes(PANEL, STORE_DIM, MERGED) + f"""
select {KEYS}, {", ".join(_flag(f'''"StoreType" = '{v}' ''', f"StoreType_{v}") for v in "abcd")},
       {", ".join(_flag(f'''"Assortment" = '{v}' ''', f"Assortment_{v}") for v in "abc")} from merged""")
def one_hot(spark, sf_dir):
    df = retail.merged_panel(spark, sf_dir)
    hot = {
        **calendar.one_hot(F.col("StoreType"), "StoreType", "abcd"),
        **calendar.one_hot(F.col("Assortment"), "Assortment", "abc"),
    }
    return plain(df.select("Store", "Date", *[c.alias(n) for n, c in hot.items()]))


_MONTHS = """greatest((year("Date") - coalesce("CompetitionOpenSinceYear", 0)) * 12
  + month("Date") - coalesce("CompetitionOpenSinceMonth", 0), 0)"""
_DISTANCE = 'coalesce("CompetitionDistance", 100000)'


@query("competition", ctes(PANEL, STORE_DIM, MERGED) + f"""
select {KEYS}, {r(_MONTHS)} as "CompetitionOpenMonths", {_flag(f"{_MONTHS} > 0", "CompetitionOpen")},
       {_flag(f"{_DISTANCE} < 1000", "CompetitionNear")},
       {_flag(f"{_DISTANCE} >= 1000 and {_DISTANCE} < 5000", "CompetitionMedium")},
       {_flag(f"{_DISTANCE} >= 5000", "CompetitionFar")} from merged""")
def competition(spark, sf_dir):
    from daybook.operators.imputation import fill_constants

    df = fill_constants(retail.merged_panel(spark, sf_dir))
    columns = calendar.competition(
        F.year("Date"), F.month("Date"), F.col("CompetitionOpenSinceYear"), F.col("CompetitionOpenSinceMonth"),
        F.col("CompetitionDistance"),
    )
    return plain(df.select("Store", "Date", *[c.alias(n) for n, c in columns.items()]))


@query("week_key", ctes(PANEL) + f"""
select {KEYS}, {_ISO} * 100 + {i('weekofyear("Date")')} as "WeekKey" from panel""")
def week_key(spark, sf_dir):
    key = calendar.week_key(calendar.iso_year(F.col("Date")), F.weekofyear("Date"))
    return _panel_with(spark, sf_dir, {"WeekKey": key})


@query("log_target", ctes(PANEL) + f"""
select {KEYS}, {r('ln(1 + "Sales")', 8)} as "LogSales", {r('exp(ln(1 + "Sales")) - 1', 4)} as "Sales" from panel""")
def log_target(spark, sf_dir):
    logged = calendar.log_target(F.col("Sales"))
    df = retail.sales_panel(spark, sf_dir, "nation")
    return plain(
        df.select("Store", "Date", logged.alias("LogSales"), F.round(calendar.unlog_target(logged), 4).alias("Sales")), 8
    )
