"""Calendar, holiday, store and competition features as column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def iso_weekday(date: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(date) + F.lit(1)).cast("int")


def iso_year(date: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), date).cast("int")


def week_key(year: Column, week: Column) -> Column:
    return (year * F.lit(100) + week).cast("int")


def date_parts(date: Column) -> dict[str, Column]:
    return {
        "Year": F.year(date),
        "Month": F.month(date),
        "Week": F.weekofyear(date),
        "ISOYear": iso_year(date),
        "Day": F.dayofmonth(date),
        "DayOfYear": F.dayofyear(date),
    }


def weekday_flags(day_of_week: Column) -> dict[str, Column]:
    return {
        "IsSaturday": flag(day_of_week == 6),
        "IsSunday": flag(day_of_week == 7),
        "IsWeekend": flag(day_of_week >= 6),
    }


def cyclic(month: Column, day_of_week: Column, day: Column) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for name, value, period in (("Month", month, 12), ("DayOfWeek", day_of_week, 7), ("DayOfMonth", day, 31)):
        angle = F.lit(2.0 * math.pi) * value / F.lit(float(period))
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    return out


def seasons(month: Column) -> dict[str, Column]:
    return {
        "IsSpring": flag(month.between(3, 5)),
        "IsSummer": flag(month.between(6, 8)),
        "IsAutumn": flag(month.between(9, 11)),
        "IsWinter": flag(month.isin(12, 1, 2)),
    }


def boundaries(month: Column, day: Column) -> dict[str, Column]:
    return {
        "IsMonthStart": flag(day <= 5),
        "IsMonthEnd": flag(day >= 25),
        "IsYearStart": flag((month == 1) & (day <= 7)),
        "IsYearEnd": flag((month == 12) & (day >= 25)),
    }


def temporal(date: Column, day_of_week: Column) -> dict[str, Column]:
    """All 23 calendar features."""
    parts = date_parts(date)
    return {
        **parts,
        **weekday_flags(day_of_week),
        **cyclic(parts["Month"], day_of_week, parts["Day"]),
        **seasons(parts["Month"]),
        **boundaries(parts["Month"], parts["Day"]),
    }


def is_holiday(code: Column) -> Column:
    # An unknown code differs from '0', hence a holiday.
    return F.coalesce((code != "0").cast("int"), F.lit(1))


def holiday_codes(code: Column) -> dict[str, Column]:
    return {
        "IsHoliday": is_holiday(code),
        "IsPublicHoliday": flag(code == "a"),
        "IsEaster": flag(code == "b"),
        "IsChristmas": flag(code == "c"),
    }


def one_hot(value: Column, prefix: str, vocabulary: Sequence[str]) -> dict[str, Column]:
    return {f"{prefix}_{v}": flag(value == v) for v in vocabulary}


def competition(year: Column, month: Column, since_year: Column, since_month: Column, distance: Column) -> dict[str, Column]:
    # A store without a competitor carries SinceYear 0 and therefore a very large month count.
    months = F.greatest((year - since_year) * 12 + (month - since_month), F.lit(0.0))
    return {
        "CompetitionOpenMonths": months,
        "CompetitionOpen": flag(months > 0),
        "CompetitionNear": flag(distance < 1000),
        "CompetitionMedium": flag((distance >= 1000) & (distance < 5000)),
        "CompetitionFar": flag(distance >= 5000),
    }


def log_target(sales: Column) -> Column:
    return F.log1p(sales)


def unlog_target(value: Column) -> Column:
    return F.expm1(value)
