from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from daybook.operators import comoments, eda


def table(seed, n=700, m=5):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(n, m)) @ rng.normal(size=(m, m)) * 10.0 ** rng.integers(-3, 6, m) + 1e6
    values[:, 3] = 0.1
    known = rng.random((n, m)) < 0.8
    known[:, 0] &= np.arange(n) > 500
    return values, known


def test_parts_in_any_order_give_the_same():
    values, known = table(1)
    whole = comoments.of_rows(values, known)
    cuts = [0, 1, 5, 200, 201, 650, 700]
    total = None
    for lo, hi in zip(cuts, cuts[1:]):
        part = comoments.of_rows(values[lo:hi], known[lo:hi])
        total = part if total is None else comoments.merged(part, total)
    for a, b in zip(whole, total):
        assert np.allclose(a, b, rtol=1e-7, atol=1e-4)


def test_matrix_equals_pandas_with_nulls_and_constants(spark):
    values, known = table(2)
    frame = pd.DataFrame(np.where(known, values, np.nan), columns=list("abcde"))
    rows = [tuple(None if not k else float(v) for v, k in zip(*pair)) for pair in zip(values, known)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in "abcde")).repartition(6)
    got = {(r["a"], r["b"]): r["corr"] for r in eda.correlation_matrix(df).collect()}
    want = frame.corr()
    assert len(got) == 25
    for (a, b), corr in got.items():
        if "d" in (a, b):
            assert corr is None
        else:
            assert corr == pytest.approx(want.loc[a, b], abs=1e-9)
    assert got["a", "a"] == 1.0


def test_plan_does_not_grow_with_the_columns(spark):
    sizes = []
    for m in (3, 120):
        df = spark.range(10).selectExpr(*[f"cast(id * {k} as double) as c{k}" for k in range(m)])
        plan = eda.correlation_matrix(df)._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(plan.count("\n"))
    assert sizes[0] == sizes[1]


def test_empty_table(spark):
    assert eda.correlation_matrix(spark.createDataFrame([], "a double, b double")).collect() == []
