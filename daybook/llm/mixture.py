"""Mixing overlapping sources to target weights by a min-cost flow.

A document may belong to several sources. Documents are counted by their pattern (the set of their sources): number and sum of sizes. A
flow network has an arc from the start to each pattern for every repetition (capacity: the pattern's size; the r-th
repetition costs more than the one before, so costs are convex), an arc from a pattern to each of its sources, and from a source to
the end (capacity: the source's target). The cheapest of all largest flows says how much each pattern gives to which source. Sources that share
no document, directly or through others, don't touch each other's flow: each connected part of the network is solved by
itself, by shortest augmenting paths, in a task of its own, so what one task holds are the patterns of one part, never documents.

A pattern's amount is given by whole documents. All are taken amount // size times. For what remains documents are
taken once more in the order of a seeded hash: hash cells are summed per pattern, whole cells before the amount is reached are in, and of the
`open_rows` documents or more from there on, each document that still fits is taken (first fit); then one is added or takes the place
of another as long as that ends nearer. So a pattern misses its amount by few words, where it has some small documents.

Documents of no source, of a source without a target and of size 0 are taken 0 times, null counts as size 0. A document is as often
taken as whole-number repetitions say, at most len(costs). Equal rows are told apart by a number, so copies spread over the hash. The
result hangs on the rows and the seed only, not on their order or partitioning. Extra columns pass through; a column called like an
output is replaced.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.dart import components
from daybook.llm.registry import staged
from daybook.llm.ring import inline_table

COSTS = (0, 1)  # of a token's first and second use
SEED = 11
OPEN = 1024
_SWAPS = 16
_CELL_BITS = 16
_SOURCE_ROWS = 100_000  # sources ranked by one task

Arc = tuple[int, int, int, int]  # from, to, capacity, cost


def cheapest_flow(arcs: Sequence[Arc], start: int, end: int) -> list[int]:
    """Flow on each arc of a largest flow of least cost: shortest augmenting paths with potentials; costs must not be negative."""
    out: dict[int, list[int]] = {}
    to, room, cost = [], [], []
    for a, b, capacity, price in arcs:
        for x, y, r, c in ((a, b, capacity, price), (b, a, 0, -price)):
            out.setdefault(x, []).append(len(to))
            to.append(y)
            room.append(r)
            cost.append(c)
    height = dict.fromkeys(out, 0)
    while True:
        best, by, done, heap = {start: 0}, {}, set(), [(0, start)]
        while heap:
            far, x = heapq.heappop(heap)
            if x in done:
                continue
            done.add(x)
            for e in out.get(x, ()):
                y, length = to[e], far + cost[e] + height[x] - height[to[e]]
                if room[e] and length < best.get(y, length + 1):
                    best[y], by[y] = length, e
                    heapq.heappush(heap, (length, y))
        if end not in best:
            return [room[2 * k + 1] for k in range(len(arcs))]
        height = {x: h + min(best.get(x, best[end]), best[end]) for x, h in height.items()}
        # All paths that are shortest now, each pushed to its narrowest arc; a node without a way on is closed.
        closed: set[int] = set()
        while True:
            path, on = [], [start]
            while on[-1] != end:
                x = on[-1]
                step = next((e for e in out[x] if room[e] and to[e] not in closed and to[e] not in on
                             and cost[e] + height[x] == height[to[e]]), None)
                if step is not None:
                    path.append(step)
                    on.append(to[step])
                elif path:
                    closed.add(on.pop())
                    path.pop()
                else:
                    break
            if on[-1] != end:
                break
            push = min(room[e] for e in path)
            for e in path:
                room[e] -= push
                room[e ^ 1] += push


def _solve(costs: Sequence[int]):
    """(part, pattern, size, source, quota) of one connected part -> (pattern, source, tokens)."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["pattern", "source"], kind="stable")
        patterns = {p: k for k, p in enumerate(dict.fromkeys(rows["pattern"]))}
        sources = {s: len(patterns) + k for k, s in enumerate(sorted(set(rows["source"])))}
        start, end = len(patterns) + len(sources), len(patterns) + len(sources) + 1
        size, quota = dict(zip(rows["pattern"], rows["size"])), dict(zip(rows["source"], rows["quota"]))
        arcs: list[Arc] = [(patterns[p], sources[s], len(costs) * int(z), 0) for p, s, z in zip(rows["pattern"], rows["source"], rows["size"])]
        arcs += [(start, k, int(size[p]), cost) for p, k in patterns.items() for cost in costs]
        arcs += [(k, end, int(quota[s]), 0) for s, k in sources.items()]
        tokens = cheapest_flow(arcs, start, end)[: len(rows)]
        return pd.DataFrame({"pattern": rows["pattern"], "source": rows["source"], "tokens": tokens})

    return work


def flows(patterns: DataFrame, targets: DataFrame, costs: Sequence[int] = COSTS) -> DataFrame:
    """(pattern, source, tokens). patterns: (pattern, sources, size), targets: (source, quota); keys are strings."""
    arcs = patterns.select("pattern", "size", F.explode("sources").alias("source")).join(targets, "source")
    arcs = staged(arcs.where("size > 0 and quota > 0"), "arcs")
    shared = arcs.groupBy("pattern").agg(F.min("source").alias("a"), F.collect_set("source").alias("b")).where("size(b) > 1")
    links = staged(shared.select("a", F.explode("b").alias("b")).where("a <> b").distinct(), "links")
    if links.isEmpty():
        arcs = arcs.withColumn("part", F.col("source"))
    else:
        arcs = arcs.join(components(links).withColumnRenamed("key", "source"), "source", "left")
        arcs = arcs.withColumn("part", F.coalesce("label", "source"))
    arcs = arcs.select("part", "pattern", "size", "source", "quota")
    return arcs.groupBy("part").applyInPandas(_solve(costs), "pattern string, source string, tokens long")


def _first_fit(rows: pd.DataFrame) -> pd.DataFrame:
    """Which of a pattern's open documents are taken once more: those that still fit, in hash order, then the nearest by swaps."""
    rows = rows.sort_values(["u", "size", "row"], kind="stable")
    gap, sizes = int(rows["gap"].iloc[0]), rows["size"].tolist()
    more = []
    for size in sizes:
        more.append(int(size <= gap))
        gap -= size * more[-1]
    for _ in range(_SWAPS):
        # One document more, or one in place of another, whichever ends nearest.
        left = sorted((size, k) for k, size in enumerate(sizes) if not more[k])
        ways = [(0, -1), *((size, k) for k, size in enumerate(sizes) if more[k])]
        best = (abs(gap), -1, -1)
        for size, k in ways:
            at = bisect.bisect_left(left, (gap + size, -1))
            best = min([best, *((abs(gap + size - z), k, j) for z, j in left[max(0, at - 1) : at + 1])])
        if best[0] == abs(gap):
            break
        _, out, into = best
        gap += (sizes[out] if out >= 0 else 0) - sizes[into]
        more[into] = 1
        if out >= 0:
            more[out] = 0
    return pd.DataFrame({"row": rows["row"], "more": more})


def _told_apart(rows: DataFrame) -> DataFrame:
    """`u` made different for equal rows: their number among the equal ones goes into it."""
    several = staged(rows.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "equal")
    if several.isEmpty():
        return rows
    marked = rows.join(several, "u", "left")
    equal = staged(marked.where("n is not null").withColumn("part", F.shiftright("row", 33)), "equal")
    before = Window.partitionBy("u").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = equal.groupBy("u", "part").agg(F.count(F.lit(1)).alias("k")).withColumn("before", F.coalesce(F.sum("k").over(before), F.lit(0)))
    number = F.row_number().over(Window.partitionBy("u", "part").orderBy("row")) + F.col("before")
    equal = equal.join(counts, ["u", "part"]).withColumn("u", F.xxhash64("u", number))
    return marked.where("n is null").drop("n").unionByName(equal.select(rows.columns))


def mix(
    df: DataFrame, sources: Column, size: Column, targets: DataFrame, key: Sequence[str], costs: Sequence[int] = COSTS, seed: int = SEED,
    open_rows: int = OPEN,
) -> DataFrame:
    """`df` with copies, taken (copies * size) and given (array of (source, quota, tokens) of the document's pattern).

    sources: array of names; targets: (source, quota in whole tokens). key: columns that tell documents apart, hashed with the seed.
    """
    own = [c for c in df.columns if c not in ("copies", "taken", "given")]
    names = F.array_sort(F.array_distinct(F.array_compact(F.coalesce(sources, F.array().cast("array<string>")))))
    docs = df.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("doc"), names.alias("sources"), F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), *key).alias("u"), F.monotonically_increasing_id().alias("row"),
    )
    docs = staged(docs.withColumn("pattern", F.to_json("sources")), "sized")
    rows = staged(_told_apart(docs.where("size > 0").select("pattern", "size", "u", "row")), "told")
    patterns = docs.where("size > 0").groupBy("pattern").agg(F.any_value("sources").alias("sources"), F.sum("size").alias("size"))
    patterns = staged(patterns, "patterns")
    flow = staged(flows(patterns, targets, costs), "flows")
    given = flow.join(targets, "source").groupBy("pattern").agg(
        F.sum("tokens").alias("amount"), F.array_sort(F.collect_list(F.struct("source", "quota", "tokens"))).alias("given")
    )
    plan = patterns.select("pattern", "size").join(given, "pattern")
    plan = plan.select("pattern", F.floor(F.col("amount") / F.col("size")).alias("whole"), F.expr("amount % size").alias("part"), "given")
    # Hash cells in order: before the amount is reached, open, after.
    cell = F.shiftrightunsigned("u", 64 - _CELL_BITS).alias("cell")
    rows = rows.withColumn("cell", cell)
    cells = rows.groupBy("pattern", "cell").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("pattern").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumns({"end": F.sum("size").over(running), "rank": F.sum("n").over(running)}).join(plan, "pattern")
    first = F.min(F.when(F.col("end") > F.col("part"), F.struct("cell", (F.col("end") - F.col("size")).alias("before"), (F.col("rank") - F.col("n")).alias("r"))))
    cells = staged(cells.withColumn("first", first.over(Window.partitionBy("pattern"))), "cells")
    at = F.when(F.col("cell") < F.col("first.cell"), 0).when(F.col("rank") - F.col("n") < F.col("first.r") + open_rows, 1).otherwise(2)
    state = F.when(F.col("part") == 0, 2).otherwise(at)
    cells = cells.select("pattern", "cell", "whole", "given", state.alias("state"), (F.col("part") - F.col("first.before")).alias("gap"))
    dealt = staged(rows.join(cells, ["pattern", "cell"]).select("pattern", "size", "u", "row", "whole", "given", "state", "gap"), "dealt")
    fitted = dealt.where("state = 1").select("pattern", "size", "u", "row", "gap").groupBy("pattern").applyInPandas(_first_fit, "row long, more int")
    dealt = dealt.join(fitted, "row", "left").select(
        "row", (F.col("whole") + F.coalesce("more", (F.col("state") == 0).cast("int"))).alias("copies"), "given"
    )
    out = docs.join(dealt, "row", "left").withColumn("copies", F.coalesce("copies", F.lit(0)).cast("int"))
    return out.select("doc.*", "copies", (F.col("copies") * F.col("size")).alias("taken"), "given")


def ranked(distinct: DataFrame, column: str) -> DataFrame:
    """`df` of different values with `rank` from 0, ascending, null last; ranges of values are ranked on their own."""
    parts = max(1, -(-distinct.count() // _SOURCE_ROWS))
    placed = distinct.repartitionByRange(parts, F.col(column).asc_nulls_last()).withColumn("_part", F.spark_partition_id().cast("long"))
    placed = staged(placed, "ranges")
    counts = {r["_part"]: r["n"] for r in placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, starts = 0, []
    for part in sorted(counts):
        starts.append((part, before))
        before += counts[part]
    within = Window.partitionBy("_part").orderBy(F.col(column).asc_nulls_last())
    starts = F.broadcast(inline_table(distinct, starts, ["_part", "_before"]))  # a row for each range
    return placed.join(starts, "_part").withColumn("rank", F.row_number().over(within) - 1 + F.col("_before")).drop("_part", "_before")


def weighed_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """`target` for each (source, size): sources weigh `weights` in turn and share `share` of all sizes, each at most `most` times its size.

    What goes beyond a source's limit is shared by the others by weight until none is above. Sources are few or many; only sums reach
    the driver, one job for each round.
    """
    places = ranked(sizes, "source").withColumn("weight", F.get(F.array(*map(F.lit, map(float, weights))), (F.col("rank") % len(weights)).cast("int")))
    places = staged(places.withColumn("limit", F.lit(float(most)) * F.col("size")), "weights")
    total = share * (places.agg(F.sum("size")).first()[0] or 0)
    level, above = 0.0, None
    while True:
        over = F.lit(level) * F.col("weight") > F.col("limit")
        n, spent, weight = places.agg(
            F.count_if(over), F.coalesce(F.sum(F.when(over, F.col("limit"))), F.lit(0.0)), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if n == above or not weight:
            break
        level, above = (total - spent) / weight, n
    return places.withColumn("target", F.least(F.lit(level) * F.col("weight"), F.col("limit"))).drop("limit", "rank")
