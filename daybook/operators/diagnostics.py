"""Residual and error-distribution diagnostics, exact on all rows."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import errors
from daybook.operators.eda import pearson
from daybook.operators.quantiles import exact_percentiles, ranked_rows
from daybook.session import materialize

ACF_LAGS = 60
KDE_MIN_ROWS = 30


def residuals(df: DataFrame) -> DataFrame:
    return df.withColumn("Residual", F.col("ActualSales") - F.col("PredictedSales"))


def abs_error_cdf(df: DataFrame) -> DataFrame:
    """Every absolute error in ascending order with its cumulative percent i / n * 100."""
    values = materialize(residuals(df).select(F.abs("Residual").alias("__v")).where(F.col("__v").isNotNull()))
    return ranked_rows(values).select(
        F.col("__v").alias("AbsError"), (F.col("__i") / F.col("__n") * 100).alias("CumulativePct")
    )


def residual_percentiles(df: DataFrame) -> DataFrame:
    q = exact_percentiles(materialize(residuals(df).select("Residual")), F.abs("Residual"), (0.5, 0.75, 0.95))
    return q.select(F.col("q")[0].alias("P50"), F.col("q")[1].alias("P75"), F.col("q")[2].alias("P95"))


def residual_trend(df: DataFrame) -> DataFrame:
    """Least-squares line of the residual over the prediction."""
    return residuals(df).agg(
        F.regr_slope("Residual", "PredictedSales").alias("slope"),
        F.regr_intercept("Residual", "PredictedSales").alias("intercept"),
    )


def residuals_by_quintile(df: DataFrame, bins: int = 5) -> DataFrame:
    """Box statistics of the residual per prediction bin; edges are percentiles, the last bin is closed."""
    rows = materialize(residuals(df).select("Residual", F.col("PredictedSales").alias("p")))
    edges = exact_percentiles(rows, F.col("p"), [j / bins for j in range(bins + 1)]).select("q").scalar()
    reached = sum(((F.col("p") >= edges[j]).cast("int") for j in range(1, bins)), F.lit(0))
    binned = rows.withColumn("bin", reached).withColumns({"lo": edges[F.col("bin")], "hi": edges[F.col("bin") + 1]})
    boxes = exact_percentiles(binned, F.col("Residual"), (0.25, 0.5, 0.75), by=("bin",))
    q1, q3 = F.col("q")[0], F.col("q")[2]
    reach = (q3 - q1) * 1.5
    # `boxes` has one row per bin.
    return (
        binned.join(F.broadcast(boxes), "bin")
        .groupBy("bin")
        .agg(
            F.first("lo").alias("bin_from"),
            F.first("hi").alias("bin_to"),
            F.count("Residual").alias("n"),
            F.min("Residual").alias("min"),
            F.first(q1).alias("q1"),
            F.first(F.col("q")[1]).alias("median"),
            F.first(q3).alias("q3"),
            F.max("Residual").alias("max"),
            F.min(F.when(F.col("Residual") >= q1 - reach, F.col("Residual"))).alias("whisker_low"),
            F.max(F.when(F.col("Residual") <= q3 + reach, F.col("Residual"))).alias("whisker_high"),
        )
    )


def qq_normal(df: DataFrame) -> DataFrame:
    """Ordered residuals against normal order-statistic medians."""
    values = materialize(residuals(df).select(F.col("Residual").cast("double").alias("__v")).where(F.col("__v").isNotNull()))
    i, n = F.col("__i"), F.col("__n")
    last = F.pow(F.lit(0.5), F.lit(1.0) / n)
    p = F.when(i == n, last).when(i == 1, 1 - last).otherwise((i - 0.3175) / (n + 0.365))
    return ranked_rows(values).select(
        i.alias("Rank"), errors.normal_ppf(p).alias("Theoretical"), F.col("__v").alias("Residual")
    )


def qq_fit(points: DataFrame) -> DataFrame:
    """Line through the Q-Q points and its correlation."""
    return points.agg(
        F.regr_slope("Residual", "Theoretical").alias("slope"),
        F.regr_intercept("Residual", "Theoretical").alias("intercept"),
        pearson(F.col("Theoretical"), F.col("Residual")).alias("r"),
    )


def _acf_sums(df: DataFrame, max_lag: int) -> DataFrame:
    """Rows and sums of lagged products p0..p<max_lag> of each store's centred residuals.

    All lags are read from one sorted window per store (a store has one row per day); no self join.
    """
    store = Window.partitionBy("Store")
    ordered = store.orderBy("Date")
    centred = residuals(df).select(
        "Store", "Date", (F.col("Residual") - F.avg("Residual").over(store)).alias("z")
    )
    lagged = centred.select(
        "Store", "z", *[(F.col("z") * F.lag("z", k).over(ordered)).alias(f"p{k}") for k in range(1, max_lag + 1)]
    )
    return lagged.groupBy("Store").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("z") * F.col("z")).alias("p0"),
        *[F.sum(f"p{k}").alias(f"p{k}") for k in range(1, max_lag + 1)],
    )


def _acf_rows(means: DataFrame, max_lag: int) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"r{k}").alias("acf")) for k in range(max_lag + 1)])
    return means.select(
        F.inline(pairs), (F.lit(1.96) / F.sqrt("avg_rows")).alias("band"), "stores_used"
    ).where(F.col("acf").isNotNull())


def residual_acf(df: DataFrame, max_lag: int = ACF_LAGS) -> DataFrame:
    """Autocorrelation per store over row lags, averaged over the stores with more than max_lag + 1 rows."""
    usable = (F.col("n") > max_lag + 1) & (F.col("p0") > 0)
    means = _acf_sums(df, max_lag).agg(
        F.avg("n").alias("avg_rows"),
        F.count_if(usable).alias("stores_used"),
        *[F.avg(F.when(usable, F.col(f"p{k}") / F.col("p0"))).alias(f"r{k}") for k in range(max_lag + 1)],
    )
    return _acf_rows(means, max_lag)


def residual_acf_pooled(df: DataFrame, max_lag: int = ACF_LAGS) -> DataFrame:
    """One estimate from all rows of all stores, for histories too short for one per store.

    Products never span two stores: the sums of the stores' lagged products over the sum of their squares.
    """
    pooled = _acf_sums(df, max_lag).agg(
        F.sum("n").alias("avg_rows"),
        F.count(F.lit(1)).alias("stores_used"),
        *[F.try_divide(F.sum(f"p{k}"), F.sum("p0")).alias(f"r{k}") for k in range(max_lag + 1)],
    )
    return _acf_rows(pooled, max_lag)


# --- distribution of the signed percentage error ----------------------------------------------------------


def error_pct(df: DataFrame) -> DataFrame:
    value = errors.signed_pct_error(F.col("ActualSales"), F.col("PredictedSales"))
    return df.select(value.alias("v")).where(F.col("v").isNotNull())


def error_pct_stats(df: DataFrame) -> DataFrame:
    return value_stats(materialize(error_pct(df)))


def value_stats(values: DataFrame) -> DataFrame:
    """Statistics of all values, and the display range: [p1, p99], or [p0.5, p99.5] when that cuts more than
    10 percent, or everything when there are fewer than 100 values."""
    q = exact_percentiles(values, F.col("v"), (0.005, 0.01, 0.5, 0.99, 0.995)).select("q").scalar()
    v = F.col("v")
    stats = values.agg(
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_pop(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.count_if((v < q[1]) | (v > q[3])).alias("cut1"),
        F.count_if((v < q[0]) | (v > q[4])).alias("cut2"),
    ).withColumns({"median": q[2], "q": q})
    small, wide = F.col("n") < 100, F.col("cut1") > F.col("n") * 0.10
    q_col = F.col("q")
    return stats.select(
        "n", "mean", "median", "std", "min", "max",
        F.when(small, F.col("min")).when(wide, q_col[0]).otherwise(q_col[1]).alias("display_low"),
        F.when(small, F.col("max")).when(wide, q_col[4]).otherwise(q_col[3]).alias("display_high"),
        F.when(small, F.lit(0)).when(wide, F.col("cut2")).otherwise(F.col("cut1")).alias("n_clipped"),
    )


def displayed_error_pct(df: DataFrame) -> DataFrame:
    """The values inside the display range, written once: bins and densities pass over them several times."""
    values = materialize(error_pct(df))
    limits = value_stats(values).select(F.struct("display_low", "display_high")).scalar()
    shown = values.where((F.col("v") >= limits["display_low"]) & (F.col("v") <= limits["display_high"]))
    return materialize(shown)


def value_summary(values: DataFrame) -> DataFrame:
    """One row of what bin and kernel widths need."""
    q = exact_percentiles(values, F.col("v"), (0.25, 0.75)).select("q").scalar()
    return values.agg(
        F.count("v").alias("n"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max")
    ).withColumns({"q25": q[0], "q75": q[1]})


def adaptive_bins(values: DataFrame) -> DataFrame:
    """Number of histogram bins: the larger of Sturges and Freedman-Diaconis within 20..80; Sturges below 50 rows."""
    n, iqr = F.col("n"), F.col("q75") - F.col("q25")
    sturges = F.ceil(F.lit(1.0) + F.log2(F.greatest(n, F.lit(1)).cast("double")))
    width = F.lit(2.0) * iqr * F.pow(n.cast("double"), F.lit(-1.0 / 3.0))
    fd = F.when(iqr < 1e-9, F.lit(10)).otherwise(F.ceil((F.col("max") - F.col("min")) / width))
    clamped = F.greatest(F.lit(20), F.least(F.greatest(fd, sturges), F.lit(80)))
    return value_summary(values).select("n", F.when(n < 50, sturges).otherwise(clamped).cast("int").alias("bins"))


def histogram(values: DataFrame, bins: int, column: str = "v", density: bool = False) -> DataFrame:
    """Equal-width bins over [min, max]; the last one is closed; empty bins are listed."""
    v = F.col(column).cast("double")
    span = values.agg(
        F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n")).alias("s")
    ).scalar()
    degenerate = span["lo"] == span["hi"]
    low = F.when(degenerate, span["lo"] - 0.5).otherwise(span["lo"])
    width = F.when(degenerate, F.lit(1.0)).otherwise(span["hi"] - span["lo"])
    index = F.least(F.floor((v - low) / width * bins), F.lit(bins - 1)).cast("int")
    counts = values.where(v.isNotNull()).groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spark = values.sparkSession
    frame = spark.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (low + F.col("id") * width / bins).alias("bin_from"),
        (low + (F.col("id") + 1) * width / bins).alias("bin_to"),
    )
    out = frame.join(counts, "bin", "left").na.fill({"n": 0})
    if density:
        out = out.withColumn("density", F.col("n") / (span["n"] * width / bins))
    return out


def kde(values: DataFrame, points: int = 200) -> DataFrame:
    """Gaussian kernel density on a fixed grid, Silverman width; empty below 30 values.

    Every task folds its rows into one vector of `points` sums, so only that crosses the shuffle.
    """
    spark = values.sparkSession
    empty = spark.createDataFrame([], "point int, x double, density double")
    summary = value_summary(values).first()
    n = summary["n"]
    if n < KDE_MIN_ROWS:
        return empty
    iqr = summary["q75"] - summary["q25"]
    spread = max(min(summary["std"], iqr / 1.34) if iqr > 1e-9 else summary["std"], 1e-6)
    width = 0.9 * spread * n ** -0.2
    margin = (summary["max"] - summary["min"]) * 0.05
    low, high = summary["min"] - margin, summary["max"] + margin
    step = (high - low) / (points - 1)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grid = low + step * np.arange(points)
        sums = np.zeros(points)
        for batch in batches:
            v = batch["v"].to_numpy()
            for start in range(0, len(v), 4096):
                u = (grid[:, None] - v[None, start : start + 4096]) / width
                sums += np.exp(-0.5 * u * u).sum(axis=1)
        yield pd.DataFrame({"point": np.arange(points, dtype="int32"), "s": sums})

    folded = values.select("v").mapInPandas(fold, "point int, s double")
    return folded.groupBy("point").agg(F.sum("s").alias("s")).select(
        "point",
        (F.lit(low) + F.col("point") * F.lit(step)).alias("x"),
        (F.col("s") / F.lit(n * width * math.sqrt(2.0 * math.pi))).alias("density"),
    )
