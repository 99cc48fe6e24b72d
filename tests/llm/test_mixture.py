"""Mixing sources: the flow, targets, and how near the taken words come."""

from __future__ import annotations

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from daybook.llm import mixture
from daybook.llm.query_mixture import op11_mixture


def total(arcs, flow):
    return sum(f * c for f, (_, _, _, c) in zip(flow, arcs))


def test_flow_is_largest_and_cheapest():
    rng = random.Random(1)
    for _ in range(60):
        inner = list(range(2, rng.choice([4, 5])))
        arcs = [(a, b, rng.randint(0, 2), rng.randint(0, 3)) for a in [0, *inner] for b in [*inner, 1] if a != b and rng.random() < 0.6]
        flow = mixture.cheapest_flow(arcs, 0, 1)
        best = None
        for some in itertools.product(*[range(c + 1) for _, _, c, _ in arcs]) if len(arcs) < 9 else ():
            even = all(sum(f for f, a in zip(some, arcs) if a[1] == x) == sum(f for f, a in zip(some, arcs) if a[0] == x) for x in inner)
            if even:
                value = sum(f for f, a in zip(some, arcs) if a[1] == 1) - sum(f for f, a in zip(some, arcs) if a[0] == 1)
                best = min(best or (1, 0), (-value, total(arcs, some)))
        value = sum(f for f, a in zip(flow, arcs) if a[1] == 1)
        assert all(0 <= f <= a[2] for f, a in zip(flow, arcs))
        assert best is None or (-value, total(arcs, flow)) == best


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        each = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if each * weight[s] > most * sizes[s]}
        if not above:
            return out | {s: each * weight[s] for s in open_}
        out |= {s: most * sizes[s] for s in above}
        left -= sum(most * sizes[s] for s in above)
        open_ -= above
    return out


def documents(seed, n=900):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        words = rng.choice([0, 1, rng.randint(2, 250)]) if k % 97 else 3000
        text = rng.choice([" ", "\n", "\t "]).join(f"w{rng.randint(0, 99)}" for _ in range(words))
        rows.append((k, rng.choice(["hot", "hot", "a", "b", "ä", None, "z"]), None if k % 51 == 0 else text))
    return rows + [rows[5]] * 3 + [(None, "hot", "same words " * 3)] * 40


def test_query_keeps_the_contract(spark, tmp_path):
    rows = documents(1)
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    df.withColumn("target", F.lit("own")).write.parquet(f"{tmp_path}/a/documents.parquet")
    df.repartition(7).write.parquet(f"{tmp_path}/b/documents.parquet")
    first, again = (sorted(map(tuple, op11_mixture(spark, f"{tmp_path}/{p}").collect()), key=str) for p in "ab")
    assert first == again and len(first) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    targets = plain_targets(sizes)
    by_target = {}
    for _, n, source_size, target, taken in first:
        assert taken in (0, n, 2 * n)
        by_target.setdefault((source_size, target), []).append(taken)
    assert sorted(k[0] for k in by_target) == sorted(sizes.values())
    for source, target in targets.items():
        near = [v for k, v in by_target.items() if k[0] == sizes[source] and k[1] == pytest.approx(target)]
        assert len(near) == 1 and sum(near[0]) == pytest.approx(target, abs=max(3, 0.001 * target))


def test_overlapping_sources_share_documents(spark):
    # Only the shared documents can serve b beyond its own; a is served by its own first.
    rows = [(k, ["a"], 10) for k in range(40)] + [(100 + k, ["a", "b", "a"], 10) for k in range(30)] + [(200, ["b"], 10), (300, [], 10), (301, None, 10)]
    df = spark.createDataFrame(rows, "doc_id long, s array<string>, n int")
    targets = spark.createDataFrame([("a", 400), ("b", 500), ("c", 10)], "source string, quota long")
    out = mixture.mix(df, F.col("s"), F.col("n"), targets, ["doc_id"]).collect()
    taken = {r["doc_id"]: r["taken"] for r in out}
    assert taken[300] == taken[301] == 0 and taken[200] in (10, 20)
    assert sum(taken[k] for k in range(40)) == 400  # once each
    assert taken[200] + sum(v for k, v in taken.items() if 100 <= k < 200) == 500  # what b asks for, a third of it again
    flow = {(g["source"], len(r["s"])): g["tokens"] for r in out for g in r["given"] or []}
    assert flow["a", 1] == 400 and flow["b", 1] + flow["b", 3] == 500 and flow["a", 3] == 0


def test_small_open_range_and_many_ranges(spark, monkeypatch):
    rows = [(k, ["a"], 1 + k % 7) for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, s array<string>, n int")
    targets = spark.createDataFrame([("a", 7000)], "source string, quota long")
    out = mixture.mix(df, F.col("s"), F.col("n"), targets, ["doc_id"], open_rows=5)
    assert abs(out.agg(F.sum("taken")).first()[0] - 7000) <= 3
    monkeypatch.setattr(mixture, "_SOURCE_ROWS", 50)
    names = spark.createDataFrame([(f"n{k:04}",) for k in range(700)] + [(None,)], "source string")
    ranks = {r["source"]: r["rank"] for r in mixture.ranked(names, "source").collect()}
    assert ranks == {f"n{k:04}": k for k in range(700)} | {None: 700}


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert op11_mixture(spark, str(tmp_path)).collect() == []
