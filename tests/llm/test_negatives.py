"""Hard negatives against plain integers."""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from daybook.llm import hard_negatives
from daybook.llm.query_negatives import op13_negatives

ROW = "vec_id long, label int, embedding array<double>, rank string"


def plain(rows, k=5, m=3):
    usable = []
    for i, (key, label, v, *_) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, key, label, [math.floor(256 * x) for x in v]))
    order = lambda s: (-s[0], s[1] is None, s[1])
    out = []
    for i, key, label, v in usable:
        if key is None or key % 50:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), other, mark) for j, other, mark, w in usable if j != i]
        for p in sorted((s for s in scored if s[2] == label), key=order)[:k]:
            fit = sorted((s for s in scored if s[2] != label and 50 * p[0] <= 100 * s[0] <= 95 * p[0]), key=order)[:m]
            out += [(key, p[1], r + 1, s[1], p[0], s[0]) for r, s in enumerate(fit)]
    return sorted(out, key=str)


def found(spark, rows, **settings):
    df = spark.createDataFrame(rows, ROW)
    out = hard_negatives.mine(df, F.col("vec_id") % 50 == 0, **settings)
    return sorted((tuple(r) for r in out.collect()), key=str)


def sample(seed, n=240, width=6, spread=0.4):
    rng = random.Random(seed)
    rows = [(k, rng.choice([0, 0, 0, 1, 2]), [rng.gauss(0.05, spread) for _ in range(width)], "x") for k in range(n)]
    return rows + [(50, 1, rows[3][2], "x"), (None, 2, rows[4][2], "x"), rows[100], rows[100]]


def test_blocks_of_any_size_equal_brute_force(spark):
    rows = sample(1)
    assert found(spark, rows) == plain(rows) != []
    assert found(spark, rows, block_rows=20) == plain(rows)


def test_odd_rows(spark):
    base = sample(2, 120)
    rows = base + [
        (500, None, [1.0], ""), (550, 1, None, ""), (600, 1, [], ""), (650, 1, [float("nan")] * 6, ""), (700, 1, [None, 1.0], ""),
        (750, 2, [float("inf")], ""), (800, 2, [0.5, 0.5], ""), (801, 1, [0.4, 0.5, 0.1], ""), (802, 2, [0.1] * 300, ""),
    ]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_wide_numbers_stay_exact(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice([0, 1]), [rng.uniform(-1, 3) * 2.0**18 for _ in range(4)], "") for k in range(110)]
    assert found(spark, rows) == plain(rows) != []


def test_packing_is_exact_for_all_widths():
    rng = np.random.default_rng(4)
    for most, width in ((3, 1), (200, 64), (2**20, 5), (2**30, 3)):
        a, c = (rng.integers(-most, most + 1, (n, width)).astype(np.float64) for n in (7, 23))
        exact = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in c] for p in a]
        assert hard_negatives.packed_scores(a, c).tolist() == exact
    assert hard_negatives._fields(np.ones((1, 64)) * -100, np.ones((1, 64)) * 100)[3] >= 1
    small = rng.integers(-100, 100, (4, 16)).astype(np.float64)
    assert hard_negatives._fields(small, small)[3] > 1  # several candidates to one multiplication


def test_query_turns_labels(spark, tmp_path):
    rows = [(k, label, v) for k, label, v, _ in sample(5)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    turned = [(k, (label + 1) % 10 if k is not None and k % 7 == 0 else label, v) for k, label, v in rows]
    assert sorted((tuple(r) for r in op13_negatives(spark, str(tmp_path)).collect()), key=str) == plain(turned)
