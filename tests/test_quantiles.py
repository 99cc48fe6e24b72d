from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.operators import quantiles

PROBS = [0, 0.005, 0.25, 0.5, 0.9, 0.995, 1]


def sample(kind):
    rng = np.random.default_rng(7)
    if kind == "ties":  # one value holds a third of all rows
        return np.where(rng.random(4000) < 0.34, 7.0, np.round(rng.normal(0, 50, 4000), 2))
    if kind == "skewed":
        return np.exp(rng.normal(0, 6, 4000))
    return rng.normal(0, 1, 4000)


@pytest.mark.parametrize("kind", ["normal", "ties", "skewed"])
@pytest.mark.parametrize("limit", [10**6, 10])
def test_percentiles_match_numpy_on_both_paths(spark, monkeypatch, kind, limit):
    monkeypatch.setattr(quantiles, "DISTINCT_LIMIT", 300)  # several ranges on the distributed path
    v = sample(kind)
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double")
    got = quantiles.exact_percentiles(df, F.col("v"), PROBS, distinct_limit=limit).first()["q"]
    assert np.allclose(got, np.percentile(v, np.array(PROBS) * 100), rtol=1e-12)


def test_grouped_percentiles(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "DISTINCT_LIMIT", 300)
    v = sample("ties")
    df = spark.createDataFrame([(i % 3, float(x)) for i, x in enumerate(v)], "g int, v double")
    got = quantiles.exact_percentiles(df, F.col("v"), PROBS, by=("g",), distinct_limit=10)
    for row in got.collect():
        assert np.allclose(row["q"], np.percentile(v[row["g"] :: 3], np.array(PROBS) * 100))


def test_ranked_rows_with_a_hot_value(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "TIE_CHUNK", 100)
    v = sample("ties")
    df = spark.createDataFrame([(float(x),) for x in v], "__v double")
    rows = quantiles.ranked_rows(df, ranges=9).orderBy("__i").toPandas()
    assert rows["__i"].tolist() == list(range(1, len(v) + 1))
    assert np.array_equal(rows["__v"], np.sort(v))
    assert set(rows["__n"]) == {len(v)}


def test_no_values(spark):
    df = spark.createDataFrame([], "v double")
    assert quantiles.exact_percentiles(df, F.col("v"), (0.5,)).first()["q"] is None
    assert quantiles.ranked_rows(df.withColumnRenamed("v", "__v"), ranges=1).count() == 0


@pytest.mark.parametrize("limit", [10**6, 10])
def test_nan_is_the_largest_value_on_both_paths(spark, monkeypatch, limit):
    monkeypatch.setattr(quantiles, "DISTINCT_LIMIT", 20)
    df = spark.createDataFrame([(float(i),) for i in range(50)] + [(float("nan"),)], "v double")
    got = quantiles.exact_percentiles(df, F.col("v"), [0.5, 1.0], distinct_limit=limit).first()["q"]
    assert got[0] == 25.0 and np.isnan(got[1])
