"""Exploratory and business reports over the cleaned panel."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import comoments
from daybook.operators.quantiles import exact_percentiles
from daybook.session import materialize


def sales_by_weekday(df: DataFrame) -> DataFrame:
    return df.groupBy("DayOfWeek").agg(
        F.avg("Sales").alias("mean"), F.stddev_samp("Sales").alias("std"), F.count("Sales").alias("count")
    )


def best_weekday(df: DataFrame) -> DataFrame:
    return sales_by_weekday(df).agg(F.max_by("DayOfWeek", F.struct("mean", -F.col("DayOfWeek"))).alias("best_weekday"))


def promo_effect(df: DataFrame) -> DataFrame:
    means = df.groupBy("Promo").agg(F.avg("Sales").alias("mean"), F.count("Sales").alias("count"))
    lift = df.agg(
        ((F.try_divide(F.avg(F.when(F.col("Promo") == 1, F.col("Sales"))),
                       F.avg(F.when(F.col("Promo") == 0, F.col("Sales")))) - 1) * 100)
    )
    return means.withColumn("diff_percent", lift.scalar())


def monthly_seasonality(df: DataFrame) -> DataFrame:
    return df.groupBy(F.month("Date").alias("Month")).agg(F.avg("Sales").alias("mean"))


def best_month(df: DataFrame) -> DataFrame:
    return monthly_seasonality(df).agg(
        F.max_by("Month", F.struct("mean", -F.col("Month"))).alias("best_month"), F.max("mean").alias("mean")
    )


def store_ranking(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("Store")
        .agg(F.avg("Sales").alias("mean"), F.stddev_samp("Sales").alias("std"), F.count("Sales").alias("count"))
        .orderBy(F.col("mean").desc(), "Store")
    )


def store_extremes(df: DataFrame) -> DataFrame:
    means = df.groupBy("Store").agg(F.avg("Sales").alias("mean"))
    return means.agg(
        F.max_by("Store", F.struct("mean", -F.col("Store"))).alias("best_store"),
        F.min_by("Store", F.struct("mean", "Store")).alias("worst_store"),
        F.try_divide(F.max("mean"), F.min("mean")).alias("ratio"),
    )


def sales_summary(df: DataFrame, column: str = "Sales") -> DataFrame:
    df = materialize(df.select(column))
    median = exact_percentiles(df, F.col(column), (0.5,)).select(F.col("q")[0])
    return df.agg(
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    ).withColumn("median", median.scalar())


def dataset_overview(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.countDistinct("Store").alias("stores"),
        F.sum("Promo").alias("promo_rows"),
        (F.avg("Promo") * 100).alias("promo_pct"),
        F.min("Date").alias("date_from"),
        F.max("Date").alias("date_to"),
        F.datediff(F.max("Date"), F.min("Date")).alias("days"),
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def pearson(a: Column, b: Column) -> Column:
    """Aggregate: correlation over the rows where both are known; NULL (not an error) for a constant column."""
    a, b = a.cast("double"), b.cast("double")
    spread = F.sqrt(F.regr_sxx(a, b) * F.regr_syy(a, b))
    return F.try_divide(F.regr_sxy(a, b), F.nullif(spread, F.lit(0.0)))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long form (a, b, corr) of all ordered pairs over the rows where both are known; NULL for a constant column.

    Tasks fold their rows into co-moment matrices, which are merged in two steps: the plan is the same for any number of columns,
    and what is shuffled are a few m x m matrices per task.
    """
    columns = list(columns or numeric_columns(df))
    values = df.select(F.array(*[F.col(f"`{c}`").cast("double") for c in columns]).alias("v"))
    parts = values.mapInArrow(comoments.fold(len(columns)), comoments.SCHEMA)
    merged = parts.repartition(comoments.FAN_IN).mapInArrow(comoments.merge, comoments.SCHEMA)
    whole = merged.repartition(1).mapInArrow(comoments.merge, comoments.SCHEMA)
    return whole.mapInArrow(comoments.correlations(columns), "a string, b string, corr double")


def correlation_with(df: DataFrame, target: str = "Sales", threshold: float = 0.1) -> DataFrame:
    """Columns whose correlation with the target exceeds the threshold in size, strongest positive first."""
    others = [c for c in numeric_columns(df) if c != target]
    wide = df.agg(*[pearson(F.col(c), F.col(target)).alias(c) for c in others])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr")) for c in others])
    return wide.select(F.inline(cells)).where(F.abs("corr") > threshold).orderBy(F.col("corr").desc())


def iqr_outlier_count(df: DataFrame, column: str = "Sales", k: float = 1.5) -> DataFrame:
    df = materialize(df.select(column))
    q = exact_percentiles(df, F.col(column), (0.25, 0.75)).select("q").scalar()
    reach = (q[1] - q[0]) * k
    hits = F.count_if((F.col(column) < q[0] - reach) | (F.col(column) > q[1] + reach))
    return df.agg(
        hits.alias("outliers"), F.coalesce(F.try_divide(hits * 100, F.count(F.lit(1))), F.lit(0.0)).alias("outliers_pct")
    )


# --- business value ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class BusinessCase:
    """Cost and effect assumptions. Money without a unit is in the local currency of the project."""

    target_stores: int = 50
    working_days: int = 300
    overstock_loss: float = 0.03
    understock_loss: float = 0.05
    baseline_error: float = 25.0
    realization: float = 0.10
    exchange_rate: float = 100.0
    labor_cost: float = 2500 * 8 * 90 + 2800 * 8 * 60 + 2000 * 6 * 40 + 2600 * 4 * 30 + 2200 * 4 * 90
    team_size: int = 5
    workstation_cost: float = 80_000.0
    workstation_years: float = 5.0
    dev_months: float = 90 / 22
    power_monthly: float = 500.0
    network_monthly: float = 800.0
    integration_cost: float = 500_000.0
    maintenance_share: float = 0.20
    servers_yearly: float = 360_000.0
    support_seats: int = 2

    @property
    def development_cost(self) -> float:
        seats = self.workstation_cost / self.workstation_years
        depreciation = seats * self.team_size * self.dev_months / 12
        overhead = (self.power_monthly * self.team_size + self.network_monthly) * self.dev_months
        return self.labor_cost + depreciation + overhead + self.integration_cost

    @property
    def yearly_cost(self) -> float:
        seats = self.workstation_cost / self.workstation_years * self.support_seats
        return self.labor_cost * self.maintenance_share + self.servers_yearly + seats

    @property
    def loss_rate(self) -> float:
        return self.overstock_loss + self.understock_loss


def business_value(df: DataFrame, model_error: float, case: BusinessCase = BusinessCase()) -> DataFrame:
    """One row: revenue base, yearly loss with and without the model, saving, ROI percent, payback months."""
    base = df.agg(
        F.countDistinct("Store").alias("n_stores"),
        F.avg(F.when(F.col("Sales") > 0, F.col("Sales"))).alias("avg_daily_revenue"),
    )
    revenue = F.col("annual_revenue")
    saving, net = F.col("annual_saving"), F.col("net_effect")
    return (
        base.withColumn("annual_revenue", F.lit(float(case.target_stores * case.working_days)) * F.col("avg_daily_revenue"))
        .withColumns({
            "annual_loss_baseline": revenue * F.lit(case.loss_rate * case.baseline_error / 100),
            "annual_loss_model": revenue * F.lit(case.loss_rate * model_error / 100),
        })
        .withColumn("annual_saving", (F.col("annual_loss_baseline") - F.col("annual_loss_model")) * case.realization)
        .withColumn("net_effect", saving * case.exchange_rate - case.yearly_cost)
        .withColumns({
            "roi_pct": net / case.development_cost * 100,
            "payback_months": F.when(net > 0, F.lit(case.development_cost) / net * 12),
        })
    )


BASELINE_ERRORS = (15.0, 20.0, 25.0, 30.0, 35.0)
MODEL_ERRORS = (6.0, 8.0, 10.0, 12.0, 15.0)


def scenario_grid(
    df: DataFrame,
    case: BusinessCase = BusinessCase(),
    baseline_errors: Sequence[float] = BASELINE_ERRORS,
    model_errors: Sequence[float] = MODEL_ERRORS,
) -> DataFrame:
    """Saving and payback for every pair of errors; payback 99 when the net effect is not positive.

    Revenue is aggregated to one row first; the grid of scenarios is expanded from that row.
    """
    base = business_value(df, model_errors[0], case).select("annual_revenue")
    cells = F.array(*[
        F.struct(F.lit(b).alias("baseline_error"), F.lit(m).alias("model_error"))
        for b in baseline_errors for m in model_errors
    ])
    gain = (F.col("baseline_error") - F.col("model_error")) / 100
    net = F.col("annual_saving") * case.exchange_rate - case.yearly_cost
    return (
        base.select("annual_revenue", F.inline(cells))
        .withColumn("annual_saving", F.col("annual_revenue") * case.loss_rate * gain * case.realization)
        .withColumn("payback_months", F.when(net > 0, F.lit(case.development_cost) / net * 12).otherwise(99.0))
    )
