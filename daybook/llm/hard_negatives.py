"""Hard negatives by exact inner products of whole-number vectors, several candidates to one multiplication.

Each component x counts as floor(scale * x). Kronecker packing: the components of several candidates, moved up by a bias so that
none is negative, stand side by side in the fields of one wide integer, wide enough for a whole inner product. An anchor's component
is multiplied with such an integer once; the sum over the components holds the inner products of all those candidates, and
the fields, less what the biases added, are the exact scores. Field width and number follow from the ranges in the block: the wide integer
is the 53-bit one of a double while a field fits there (so that the products are one matrix product and every sum in it is exact),
else one of any width.

Anchors meet all rows in blocks of bounded size: rows are dealt by a hash of their number, each (anchor block, candidate block) is one
group. A first pass keeps the best rows of the anchor's own label per group, a window merges them. A second pass takes the anchors
with their positives' scores and keeps, per positive, the best rows of other labels between the two shares of the positive's
score. So what leaves a group is bounded by its anchors, and a label with a third of all rows is only more blocks.

Rows with a null label, a null vector or a null or non-finite component take no part. Vectors of different lengths are compared over
the shorter one; an empty vector scores 0. Equal scores go by smaller id, a null id last. A row is never its own positive, an equal
row is; repeated anchors are anchors each. A score beyond 64 bits is an error. Extra columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.registry import staged

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # percent of the positive's score
BLOCK_ROWS = 1 << 14
_EXACT_BITS = 53
_WIDE_FIELDS = 8


def _fields(anchors: np.ndarray, candidates: np.ndarray) -> tuple[int, int, int, int]:
    """Biases of both sides, bits of a field, fields of a wide integer."""
    a, c = -int(anchors.min()), -int(candidates.min())
    most = anchors.shape[1] * (int(anchors.max()) + a) * (int(candidates.max()) + c)
    bits = max(1, most.bit_length())
    return a, c, bits, _EXACT_BITS // bits if bits <= _EXACT_BITS else _WIDE_FIELDS


def packed_scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """All inner products of two matrices of whole numbers (doubles), as 64-bit integers."""
    n, width = len(candidates), anchors.shape[1]
    if not width or not n or not len(anchors):
        return np.zeros((len(anchors), n), np.int64)
    a, c, bits, fields = _fields(anchors, candidates)
    whole = bits <= _EXACT_BITS
    if not whole:
        anchors, candidates = (np.array([[int(x) for x in row] for row in m], object) for m in (anchors, candidates))
    groups = -(-n // fields)
    raised = np.zeros((fields, groups, width), np.float64 if whole else object)
    raised.reshape(fields * groups, width)[:n] = candidates + c
    wide = raised[0].copy()
    for f in range(1, fields):
        wide += raised[f] * (2.0 ** (bits * f) if whole else 1 << (bits * f))
    sums = (anchors + a) @ wide.T
    sums = sums.astype(np.int64) if whole else sums
    mask = (1 << bits) - 1
    out = np.concatenate([(sums >> (bits * f)) & mask for f in range(fields)], axis=1)[:, :n]
    kind = np.int64 if whole else object
    out = out - c * anchors.sum(axis=1).astype(kind)[:, None] - a * candidates.sum(axis=1).astype(kind)[None, :] - width * a * c
    return out if whole else out.astype(np.int64)


class _Vectors:
    """Whole-number vectors of a group, by length."""

    def __init__(self, column: pa.Array, scale: int):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        self.sizes = np.diff(np.asarray(column.offsets))
        first = np.asarray(column.offsets)[:-1] - column.offsets[0].as_py()
        values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
        self.matrices = {}
        for size in np.unique(self.sizes):
            at = np.flatnonzero(self.sizes == size)
            self.matrices[int(size)] = at, values[first[at][:, None] + np.arange(size)[None, :]]

    def scores(self, who: np.ndarray, others: _Vectors) -> np.ndarray:
        out = np.zeros((len(who), len(others.sizes)), np.int64)
        for size, (at, matrix) in self.matrices.items():
            mine = np.flatnonzero(self.sizes[who] == size)
            if not len(mine):
                continue
            rows = matrix[np.searchsorted(at, who[mine])]
            for other, (places, candidates) in others.matrices.items():
                short = min(size, other)
                out[np.ix_(mine, places)] = packed_scores(rows[:, :short], candidates[:, :short])
        return out


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest, equal ones by place."""
    at = np.arange(len(scores))
    if len(scores) > 4 * k:
        at = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return at[np.argsort(-scores[at], kind="stable")[:k]]


def _sides(group: pa.Table) -> tuple[pa.Table, pa.Table]:
    """Anchors, and candidates by id (null last)."""
    anchor = group.column("_anchor")
    rows = group.filter(pc.invert(anchor))
    return group.filter(anchor), rows.sort_by([("_id", "ascending")])


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _parts(anchors: pa.Table, candidates: pa.Table, scale: int) -> Iterator[tuple[int, np.ndarray]]:
    """(anchor, its scores) for all anchors of a group, some MB of scores at a time."""
    left, right = _Vectors(anchors.column("_vector"), scale), _Vectors(candidates.column("_vector"), scale)
    step = max(1, (1 << 20) // max(1, len(candidates)))
    for lo in range(0, len(anchors), step):
        who = np.arange(lo, min(lo + step, len(anchors)))
        yield from zip(who.tolist(), left.scores(who, right))


_FOUND = "_row long, _k int, id long, score long"
_FOUND_ARROW = pa.schema([("_row", pa.int64()), ("_k", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def _table(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows) if rows else [[]] * 4
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _FOUND_ARROW)], schema=_FOUND_ARROW)


def _positives(k: int, scale: int):
    def work(group: pa.Table) -> pa.Table:
        anchors, candidates = _sides(group)
        own, labels = _numbers(anchors, "_label"), _numbers(candidates, "_label")
        rows, numbers = _numbers(anchors, "_row"), _numbers(candidates, "_row")
        found = []
        for label in np.unique(own):
            same = np.flatnonzero(labels == label)
            mine = np.flatnonzero(own == label)
            some = candidates.take(same)
            ids = some.column("_id").to_pylist()
            for i, scores in _parts(anchors.take(mine), some, scale) if len(same) else ():
                row = int(rows[mine[i]])
                best = [j for j in _best(scores, k + 1).tolist() if numbers[same[j]] != row][:k]
                found += [(row, 0, ids[j], int(scores[j])) for j in best]
        return _table(found)

    return work


def _negatives(k: int, low: int, high: int, scale: int):
    def work(group: pa.Table) -> pa.Table:
        anchors, candidates = _sides(group)
        own, labels = _numbers(anchors, "_label"), _numbers(candidates, "_label")
        rows, ids = _numbers(anchors, "_row"), candidates.column("_id")
        wanted = anchors.column("_scores").to_pylist()
        found = []
        for i, scores in _parts(anchors, candidates, scale) if len(candidates) else ():
            limits = [(-(-low * p // 100), high * p // 100) for p in wanted[i]]
            least, most = min(a for a, _ in limits), max(b for _, b in limits)
            at = np.flatnonzero((scores >= least) & (scores <= most) & (labels != own[i]))
            at = at[np.argsort(-scores[at], kind="stable")]
            falling = -scores[at]
            for rank, (a, b) in enumerate(limits):
                first = int(np.searchsorted(falling, -b, side="left"))
                last = min(first + k, int(np.searchsorted(falling, -a, side="right")))
                found += [(int(rows[i]), rank, ids[int(j)].as_py(), int(scores[j])) for j in at[first:last]]
        return _table(found)

    return work


def _meet(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int]) -> DataFrame:
    """Both sides of every (anchor block, candidate block)."""
    own = lambda n: F.pmod(F.xxhash64("_row"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.select("*", F.lit(True).alias("_anchor"), own(blocks[0]).alias("_a"), each(blocks[1]).alias("_c"))
    right = rows.select("_row", "_id", "_label", "_vector", F.lit(None).cast("array<long>").alias("_scores"),
                        F.lit(False).alias("_anchor"), own(blocks[1]).alias("_c"), each(blocks[0]).alias("_a"))
    return left.unionByName(right).groupBy("_a", "_c")


def mine(
    df: DataFrame, is_anchor: Column, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", positives: int = POSITIVES,
    negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, for each anchor and positive up to `negatives` rows."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    vectors = F.col(vector)
    clean = df.where(F.col(label).isNotNull() & vectors.isNotNull() & F.forall(vectors, finite))
    clean = clean.select(
        F.col(vec_id).cast("long").alias("_id"), F.col(label).cast("long").alias("_label"), vectors.alias("_vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("_is"), F.monotonically_increasing_id().alias("_row"),
    )
    rows = staged(clean, "vectors")
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if("_is")).first()
    spread = min(math.ceil(n / 1024), 2 * df.sparkSession.sparkContext.defaultParallelism)
    blocks = max(1, math.ceil(n_anchors / block_rows)), max(1, math.ceil(n / block_rows), spread)
    columns = ["_row", "_id", "_label", "_vector"]
    anchors = rows.where("_is").select(*columns, F.lit(None).cast("array<long>").alias("_scores"))
    order = [F.desc("score"), F.asc_nulls_last("id")]
    near = _meet(anchors, rows, blocks).applyInArrow(_positives(positives, scale), _FOUND)
    rank = F.row_number().over(Window.partitionBy("_row").orderBy(*order))
    near = near.withColumn("_k", rank - 1).where(F.col("_k") < positives).withColumnsRenamed({"id": "positive_id", "score": "positive_score"})
    near = staged(near, "positives")
    wanted = near.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_k", "positive_score"))).alias("_p"))
    anchors = rows.where("_is").join(wanted.select("_row", F.col("_p.positive_score").alias("_scores")), "_row")
    far = _meet(anchors.select(*columns, "_scores"), rows, blocks).applyInArrow(_negatives(negatives, low, high, scale), _FOUND)
    rank = F.row_number().over(Window.partitionBy("_row", "_k").orderBy(*order))
    far = far.withColumn("rank", rank).where(F.col("rank") <= negatives)
    named = rows.where("_is").select("_row", F.col("_id").alias("anchor_id"))
    return far.join(near, ["_row", "_k"]).join(named, "_row").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
