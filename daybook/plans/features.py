"""The feature job: name contract, validation and the single-select plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.config import DEFAULT_CONFIG, EngineConfig
from daybook.functions import calendar
from daybook.operators import imputation, panel
from daybook.schemas import REQUIRED_FEATURE_INPUT, require_columns

EXCLUDED = (
    "Date", "Sales", "Customers", "Open", "StateHoliday", "StoreType", "Assortment", "PromoInterval", "PromoSequence",
)
PASS_THROUGH = (
    "Store", "DayOfWeek", "Promo", "SchoolHoliday", "CompetitionDistance", "CompetitionOpenSinceMonth",
    "CompetitionOpenSinceYear", "Promo2", "Promo2SinceWeek", "Promo2SinceYear",
)
TEMPORAL = (
    "Year", "Month", "Week", "ISOYear", "Day", "DayOfYear", "IsSaturday", "IsSunday", "IsWeekend",
    "Month_sin", "Month_cos", "DayOfWeek_sin", "DayOfWeek_cos", "DayOfMonth_sin", "DayOfMonth_cos",
    "IsSpring", "IsSummer", "IsAutumn", "IsWinter", "IsMonthStart", "IsMonthEnd", "IsYearStart", "IsYearEnd",
)
PROMO = ("PromoSequenceLength", "DaysSinceLastPromo", "IsPromoStart", "IsPromoEnd")
HOLIDAY = (
    "IsHoliday", "IsPublicHoliday", "IsEaster", "IsChristmas",
    "WasHolidayYesterday", "IsHolidayTomorrow", "WasHolidayLastWeek",
)
COMPETITION = ("CompetitionOpenMonths", "CompetitionOpen", "CompetitionNear", "CompetitionMedium", "CompetitionFar")


def feature_names(config: EngineConfig = DEFAULT_CONFIG) -> list[str]:
    return [
        *PASS_THROUGH,
        *imputation.FLAGS,
        *TEMPORAL,
        *PROMO,
        *HOLIDAY,
        *[f"StoreType_{v}" for v in config.store_types],
        *[f"Assortment_{v}" for v in config.assortments],
        *COMPETITION,
        *panel.lag_columns(config.lag_days),
    ]


def validate_input(df: DataFrame) -> None:
    require_columns(df.columns, REQUIRED_FEATURE_INPUT, "feature input")
    if not isinstance(df.schema["Date"].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError("feature input: Date must be a date or timestamp")


def row_features(df: DataFrame, config: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    """Features that need nothing but their own row."""
    out = dict(calendar.temporal(F.col("Date"), F.col("DayOfWeek")))
    if "StoreType" in df.columns:
        out.update(calendar.one_hot(F.col("StoreType"), "StoreType", config.store_types))
    if "Assortment" in df.columns:
        out.update(calendar.one_hot(F.col("Assortment"), "Assortment", config.assortments))
    if "CompetitionDistance" in df.columns and "CompetitionOpenSinceYear" in df.columns:
        out.update(
            calendar.competition(
                F.year("Date"), F.month("Date"), F.col("CompetitionOpenSinceYear"),
                F.col("CompetitionOpenSinceMonth"), F.col("CompetitionDistance"),
            )
        )
    return df.withColumns(out)


def build_features(
    df: DataFrame, config: EngineConfig = DEFAULT_CONFIG, lags: bool = True, imputed: bool = False
) -> DataFrame:
    """Cleaned rows -> Store, Date, Sales and the feature columns. Row count is unchanged.

    Two window stages over one exchange: the first reads input columns only, the second reads the results of
    the first (run lengths and expanding fills). Row features are projected on top, so they stay in codegen.
    """
    validate_input(df)
    df = df if imputed else imputation.impute(df)
    stage = {
        "__changed": panel.promo_changed(),
        "__row": F.row_number().over(panel.by_day()),
        "DaysSinceLastPromo": panel.days_since_last_promo(),
        **panel.promo_edges(),
    }
    if "StateHoliday" in df.columns:
        holiday = calendar.is_holiday(F.col("StateHoliday"))
        stage |= {
            **calendar.holiday_codes(F.col("StateHoliday")),
            **panel.holiday_neighbours(holiday),
            "WasHolidayLastWeek": panel.holiday_last_week(holiday),
        }
    second = {"PromoSequenceLength": panel.promo_sequence_length(F.col("__changed"), F.col("__row"))}
    if lags:
        stage |= panel.lag_expressions(config.lag_days)
        second |= panel.expanding_fill_expressions(panel.lag_columns(config.lag_days))
    wide = panel.with_day(df).withColumns(stage).withColumns(second)
    wide = row_features(wide, config)
    names = [c for c in feature_names(config) if c in wide.columns]
    return wide.select(*names, "Sales", "Date")


def align_features(df: DataFrame, model_features: Sequence[str] | None) -> DataFrame:
    """Model order; features the data lacks become NULL, features the model lacks are dropped."""
    if not model_features:
        return df
    have = set(df.columns)
    keep = [c for c in ("Date", "Sales") if c in have]
    return df.select(*[F.col(c) if c in have else F.lit(None).cast("double").alias(c) for c in model_features], *keep)
