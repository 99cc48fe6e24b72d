"""Exact quantiles and ranks over any number of rows.

Values are counted first: ties collapse on the map side and the counts spread over all reducers. While a group's
distinct values are few (their number is measured), one task takes the percentiles from the counted values. Beyond the
limit the counted values are cut into ranges of similar size, each range is ranked on its own and shifted by the
total of the ranges before it. NaN is the largest value on both ways.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DISTINCT_LIMIT = 1_000_000  # distinct values one task may hold
TIE_CHUNK = 1_000_000  # rows one explode may produce from a single tied value


def distinct_estimate(df: DataFrame, *columns: str) -> int:
    row = df.agg(F.approx_count_distinct(F.struct(*columns), 0.02).alias("n")).first()
    return int(row["n"])


def exact_percentiles(
    df: DataFrame,
    value: Column,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    name: str = "q",
    distinct_limit: int = DISTINCT_LIMIT,
) -> DataFrame:
    """Linear-interpolation percentiles of the non-null values: columns `by` + `name` (array<double>)."""
    values = df.select(*by, value.cast("double").alias("__v")).where(F.col("__v").isNotNull())
    probs = [float(p) for p in probabilities]
    if distinct_estimate(values, *by, "__v") <= distinct_limit:
        counted = values.groupBy(*by, "__v").agg(F.count(F.lit(1)).alias("__c"))
        return counted.groupBy(*by).agg(F.percentile("__v", F.array(*[F.lit(p) for p in probs]), F.col("__c")).alias(name))
    return _percentiles_from_ranks(value_ranks(values, by), probs, by, name)


def value_ranks(values: DataFrame, by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """Distinct `__v` per group with its multiplicity `__c` and last 1-based rank `__end`."""
    cells = values.groupBy(*by, "__v").agg(F.count(F.lit(1)).alias("__c"))
    if ranges is None:
        ranges = math.ceil(distinct_estimate(values, *by, "__v") / DISTINCT_LIMIT)
    cells = _value_range(cells, ranges)
    in_range = Window.partitionBy(*by, "__range").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = cells.withColumn("__end", F.sum("__c").over(in_range))
    if ranges <= 1:
        return ranked.drop("__range")
    # One row per million distinct values of a group, so this window is small.
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cells.groupBy(*by, "__range")
        .agg(F.sum("__c").alias("__rows"))
        .withColumn("__offset", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
        .drop("__rows")
    )
    keys = [*by, "__range"]
    return (
        ranked.join(offsets, keys)
        .withColumn("__end", F.col("__end") + F.col("__offset"))
        .drop("__range", "__offset")
    )


def ranked_rows(values: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row per input value: `__v`, `__i` (1-based rank) and `__n` (number of values)."""
    ranks = value_ranks(values, (), ranges)
    total = values.agg(F.count("__v").alias("n"))
    # A heavily tied value is first cut into chunks and spread, then expanded.
    chunks = (
        ranks.withColumn("__k", F.explode(F.sequence(F.lit(0), ((F.col("__c") - 1) / TIE_CHUNK).cast("int"))))
        .repartition("__v", "__k")
        .withColumn("__start", F.col("__end") - F.col("__c") + F.col("__k") * F.lit(TIE_CHUNK))
        .withColumn("__len", F.least(F.lit(TIE_CHUNK), F.col("__c") - F.col("__k") * F.lit(TIE_CHUNK)))
    )
    return chunks.select(
        "__v",
        F.explode(F.sequence(F.col("__start") + 1, F.col("__start") + F.col("__len"))).alias("__i"),
        total.scalar().alias("__n"),
    )


def _value_range(cells: DataFrame, ranges: int) -> DataFrame:
    """Tag each distinct value with a monotone range number; ranges hold similar numbers of cells."""
    if ranges <= 1:
        return cells.withColumn("__range", F.lit(0.0))
    grid = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    cuts = cells.agg(F.percentile_approx("__v", grid, F.lit(min(20 * ranges, 1_000_000))).alias("q")).first()["q"]
    splits = [-math.inf, *sorted({c for c in cuts or [] if math.isfinite(c)}), math.inf]
    if len(splits) < 3:
        return cells.withColumn("__range", F.lit(0.0))
    # "keep" puts NaN into a range of its own after the others.
    return Bucketizer(splits=splits, inputCol="__v", outputCol="__range", handleInvalid="keep").transform(cells)


def _percentiles_from_ranks(ranks: DataFrame, probs: Sequence[float], by: Sequence[str], name: str) -> DataFrame:
    n = ranks.groupBy(*by).agg(F.max("__end").alias("__n"))
    ranked = ranks.join(n, list(by)) if by else ranks.withColumn("__n", n.select("__n").scalar())
    picks = []
    for i, p in enumerate(probs):
        position = F.lit(p) * (F.col("__n") - 1)
        for label, rank in ((f"__lo{i}", F.floor(position) + 1), (f"__hi{i}", F.ceil(position) + 1)):
            inside = (F.col("__end") >= rank) & (F.col("__end") - F.col("__c") < rank)
            picks.append(F.max(F.when(inside, F.col("__v"))).alias(label))
    picked = ranked.groupBy(*by).agg(F.max("__n").alias("__n"), *picks)
    interpolated = []
    for i, p in enumerate(probs):
        position = F.lit(p) * (F.col("__n") - 1)
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        interpolated.append(lo + (position - F.floor(position)) * (hi - lo))
    return picked.select(*by, F.array(*interpolated).alias(name))
