"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns `nodes` points of the ring, a key goes to the first point at or after its hash. A shard that is full
passes the keys beyond its bound on to the next point clockwise whose shard has room. The bounds add up to the number of rows
(shard k holds n // shards rows, one more if k < n % shards), so counts are at most one apart, while most rows stay at
their first point.

Keys arrive in ring order: arc by arc, and by hash within an arc. So which rows of an arc are passed on follows from the
counts of the arcs, a table of bounded size (`nodes` x shards arcs, cut into `cuts` parts each); the walk over it
is done once on the driver and comes back as ranges of ranks. Equal rows are counted before anything is shuffled and
numbered afterwards, so a key with a third of all rows is one row in the shuffle; ranks are running sums within
the parts of arcs. Only built-in functions are used.

Null keys are keys like any other (they hash alike and are told apart by the other columns). The result has one row per
input row: the key columns, `shard`, `slot` (from 0 without gaps in each shard), `home_shard` (the first point's shard).
"""

from __future__ import annotations

import bisect
import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.registry import staged

CELLS = 1 << 16
_CHUNK = 4096  # equal rows numbered by one row of an explode


def ring_points(shards: int, nodes: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node in ring order; the first claim to a cell stands, by shard and node."""
    taken: dict[int, int] = {}
    for shard in range(shards):
        for node in range(nodes):
            cell = int.from_bytes(hashlib.md5(f"{shard}/{node}".encode()).digest()[:4], "big") % CELLS
            taken.setdefault(cell, shard)
    return sorted(taken.items())


def walk(parts: list[tuple[int, int, int]], owners: list[int], shards: int) -> list[tuple[int, int, int, int, int, int]]:
    """Ranges of ranks by part: (arc, cut, first rank, last rank, shard, slot of the first).

    parts: (arc, cut, rows) in arrival order. owners: shard of each arc's point, in ring order.
    """
    total = sum(n for _, _, n in parts)
    room = [total // shards + (k < total % shards) for k in range(shards)]
    filled, out = [0] * shards, []
    for arc, cut, n in parts:
        rank, at = 0, arc
        while rank < n:
            shard = owners[at % len(owners)]
            take = min(n - rank, room[shard])
            if take:
                out.append((arc, cut, rank, rank + take - 1, shard, filled[shard]))
                room[shard] -= take
                filled[shard] += take
                rank += take
            at += 1
    return out


def inline_table(df: DataFrame, rows: list[tuple], names: list[str]) -> DataFrame:
    """A few rows of longs as a table made by the planner."""
    schema = "array<struct<" + ",".join(f"{n}:bigint" for n in names) + ">>"
    text = json.dumps([dict(zip(names, r)) for r in rows])
    return df.sparkSession.range(1).select(F.inline(F.from_json(F.lit(text), schema)))


def assign(df: DataFrame, key: str, shards: int = 16, nodes: int = 64, cuts: int = 16) -> DataFrame:
    """One row per row of `df`: its columns, shard, slot and home_shard. Take only the columns you need: they are shuffled."""
    columns = df.columns
    points = ring_points(shards, nodes)
    cells, owners = [c for c, _ in points], [s for _, s in points]
    arcs = [bisect.bisect_left(cells, c) % len(cells) for c in range(CELLS)]
    order: Column = F.xxhash64(F.col(key))
    counted = df.groupBy(columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_h", order)
    arc_of = inline_table(df, [(c, a) for c, a in enumerate(arcs)], ["_cell", "_arc"])
    placed = counted.withColumn("_cell", F.shiftrightunsigned("_h", 48)).join(F.broadcast(arc_of), "_cell")
    placed = placed.withColumn("_cut", F.pmod(F.shiftrightunsigned("_h", 32), F.lit(cuts)))
    placed = staged(placed.select(*columns, "_n", "_h", "_arc", "_cut"), "ring")
    parts = sorted(
        (r["_arc"], r["_cut"], r["n"]) for r in placed.groupBy("_arc", "_cut").agg(F.sum("_n").alias("n")).collect()
    )  # at most shards x nodes x cuts rows
    plan = inline_table(df, walk(parts, owners, shards), ["_arc", "_cut", "_from", "_to", "shard", "_slot"])
    running = Window.partitionBy("_arc", "_cut").orderBy("_h", *columns).rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.withColumn("_start", F.sum("_n").over(running) - F.col("_n"))
    single = ranked.where("_n = 1").withColumn("_rank", F.col("_start"))
    chunks = ranked.where("_n > 1").withColumn("_at", F.explode(F.sequence(F.lit(0), F.col("_n") - 1, F.lit(_CHUNK))))
    several = chunks.repartition("_h", "_at").withColumn(
        "_rank", F.explode(F.sequence(F.col("_start") + F.col("_at"), F.col("_start") + F.least(F.col("_at") + _CHUNK, F.col("_n")) - 1))
    )
    kept = [*columns, "_arc", "_cut", "_rank"]
    ranges = F.broadcast(plan)  # at most one row for each part and two for each shard
    rows = single.select(kept).unionByName(several.select(kept))
    rows = rows.join(ranges, ["_arc", "_cut"]).where("_rank between _from and _to")
    home = F.broadcast(inline_table(df, list(enumerate(owners)), ["_arc", "home_shard"]))
    return rows.join(home, "_arc").select(
        *columns,
        F.col("shard").cast("int").alias("shard"),
        (F.col("_slot") + F.col("_rank") - F.col("_from")).alias("slot"),
        F.col("home_shard").cast("int").alias("home_shard"),
    )
