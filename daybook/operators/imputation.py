"""Null handling: flags, constants, modes and medians, in the order the features expect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_COMPETITOR_DISTANCE = 100_000.0
BINARY_COLUMNS = ("Open", "Promo", "SchoolHoliday")
COMPETITION_SINCE = ("CompetitionOpenSinceMonth", "CompetitionOpenSinceYear")
PROMO2_SINCE = ("Promo2SinceWeek", "Promo2SinceYear")
FLAGS = ("HasCompetition", "InPromo2")


def null_flags(df: DataFrame) -> DataFrame:
    """HasCompetition / InPromo2, taken before anything is filled."""
    flags: dict[str, Column] = {}
    if "CompetitionDistance" in df.columns and "CompetitionOpenSinceYear" in df.columns:
        flags["HasCompetition"] = F.col("CompetitionOpenSinceYear").isNotNull().cast("int")
    if "Promo2SinceYear" in df.columns:
        flags["InPromo2"] = F.col("Promo2SinceYear").isNotNull().cast("int")
    return df.withColumns(flags) if flags else df


def fill_constants(df: DataFrame) -> DataFrame:
    fills: dict[str, object] = {"CompetitionDistance": NO_COMPETITOR_DISTANCE, "PromoInterval": "NoPromo"}
    fills.update({c: 0.0 for c in COMPETITION_SINCE + PROMO2_SINCE})
    return df.na.fill({c: v for c, v in fills.items() if c in df.columns})


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One pass, long output: `column`, `nulls`."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns])
    return wide.select(F.inline(pairs))


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return null_counts(df, columns).where(F.col("nulls") > 0)


def columns_with_nulls(df: DataFrame, columns: Sequence[str]) -> list[str]:
    if not columns:
        return []
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] > 0]


def column_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the most frequent value of each column as text (smallest on ties), any cardinality.

    Counts are combined map-side per (column, value), so no task holds all the values of a column.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"), F.col(c).try_cast("double").alias("x")) for c in columns])
    counts = df.select(F.inline(pairs)).where(F.col("v").isNotNull()).groupBy("c", "v", "x").agg(F.count(F.lit(1)).alias("n"))
    # Largest count wins; on ties the smallest number, then the smallest text.
    best = counts.groupBy("c").agg(F.min_by("v", F.struct(-F.col("n"), "x", "v")).alias("v"))
    return best.agg(*[F.max(F.when(F.col("c") == c, F.col("v"))).alias(c) for c in columns])


def _fill_mode(df: DataFrame, columns: Sequence[str], default: Column, cast: str | None) -> DataFrame:
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    modes = column_modes(df, columns).select(F.struct(*columns)).scalar()  # one subquery for all columns
    filled = {}
    for c in columns:
        mode = modes[c]
        value = F.coalesce(F.col(c), mode.cast("double").cast("int") if cast else mode, default)
        filled[c] = value.cast(cast) if cast else value
    return df.withColumns(filled)


def fill_binary_mode(df: DataFrame, columns: Sequence[str] = BINARY_COLUMNS) -> DataFrame:
    """Global mode (not per store), 0 when the column is all null."""
    return _fill_mode(df, columns, F.lit(0), "int")


def fill_category_mode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != "PromoInterval"]
    return _fill_mode(df, columns, F.lit("Unknown"), None)


def median_candidates(df: DataFrame) -> list[str]:
    handled = set(BINARY_COLUMNS + COMPETITION_SINCE + PROMO2_SINCE + FLAGS + ("Store", "CompetitionDistance"))
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in handled]


def fill_numeric_median(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per-store median, 0 for a store without any value.

    With a single store this is the global median as well. The store window holds at most one row per day once
    (Store, Date) is unique, so it stays small.
    """
    columns = list(median_candidates(df) if columns is None else columns)
    per_store = Window.partitionBy("Store")
    filled = {}
    for c in columns:
        value = F.col(c).cast("double")
        filled[c] = F.coalesce(value, F.percentile(value, F.lit(0.5)).over(per_store), F.lit(0.0))
    return df.withColumns(filled) if filled else df


def impute(df: DataFrame) -> DataFrame:
    """Flags, constants, then modes and medians for those columns that really hold nulls.

    One narrow aggregate finds them; a clean table pays for no mode, median or window at all.
    """
    df = fill_constants(null_flags(df))
    binary = [c for c in BINARY_COLUMNS if c in df.columns]
    numeric = median_candidates(df)
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != "PromoInterval"]
    holes = set(columns_with_nulls(df, [*binary, *numeric, *texts]))
    df = fill_binary_mode(df, [c for c in binary if c in holes])
    df = fill_numeric_median(df, [c for c in numeric if c in holes])
    return fill_category_mode(df, [c for c in texts if c in holes])
