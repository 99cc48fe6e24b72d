"""Gradient boosting that can be continued, and a search whose trials race through the same folds.

The training rows are binned once: features become bytes (quantile bins), rows become blocks of up to `BLOCK_ROWS` rows, dealt by key
and sorted. All trials and folds share this table; a fold is a range of weeks within the blocks. A boosting keeps its trees on
the driver (a few hundred numbers each) and can go on at any time: `advance` adds rounds until `patience` of them brought
nothing better on the held-out weeks.

One round fits one tree, level by level. With several blocks each level is a Spark job: tasks sum residuals per (node, feature, bin) of
their blocks, the sums of a node meet in one task as a stream, and only the best split of each node reaches the driver. The sum of
the trees so far is a column of the blocks that is written anew every `STAGE_ROUNDS` rounds; the few trees since are added on
the fly, which bounds both the work and what a lost executor costs. A single block needs no exchange, so there a task does
the rounds asked for at once, by the same functions and with the same result.

The finished model is a `GBTRegressionModel` of Spark ML: it scores in the JVM and is saved and loaded like any other.
"""

from __future__ import annotations

import json
import math
import pickle
import random
import statistics
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.config import DEFAULT_CONFIG
from daybook.ml import split
from daybook.session import scratch_path
from daybook.sources.files import remove_path

BLOCK_ROWS = 1 << 19
STAGE_ROUNDS = 25
RUNG_ROUNDS = 50  # rounds between two comparisons of the trials
BINS = 255

_BLOCK = "block int, n int, x binary, y binary, week binary, mark binary, score binary"
_SUMS = "node int, sums binary"
_BEST = "node int, best binary"


@dataclass(frozen=True)
class BoostSettings:
    max_iter: int = 10_000
    patience: int = 75  # rounds without a better holdout loss that end the boosting
    depth: int = 6
    bins: int = 117
    step: float = 0.1
    min_rows: int = 100
    row_fraction: float = 0.8
    feature_fraction: float = 0.8
    seed: int = DEFAULT_CONFIG.random_state


Weeks = tuple[int, int]  # first and last
ALL_WEEKS = (-(1 << 31), (1 << 31) - 1)


# --- binned blocks ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Binned:
    """Blocks of binned rows in the shared folder; `edges[f]` are the thresholds between the bins of feature f."""

    blocks: DataFrame
    count: int
    edges: list[np.ndarray]

    @property
    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum([len(e) + 1 for e in self.edges])])

    def close(self) -> None:
        self.blocks.unpersist()


def thresholds(rows: DataFrame, bins: int = BINS) -> list[np.ndarray]:
    """Per feature the middles between neighbouring ones of its quantiles, least and largest value."""
    values = rows.select(vector_to_array("features").alias("v"))
    shares = [k / bins for k in range(1, bins)]
    cells = values.select(F.posexplode("v").alias("f", "x")).where(~F.isnan("x"))
    quantiles = F.concat(F.percentile_approx("x", shares, 10_000), F.array(F.min("x"), F.max("x")))
    found = {r["f"]: r["q"] for r in cells.groupBy("f").agg(quantiles.alias("q")).collect()}  # at most `bins` numbers a feature
    width = rows.select(F.size(vector_to_array("features"))).first()
    edges = []
    for f in range(width[0] if width else 0):
        some = np.unique(np.array(found.get(f, []), float))
        edges.append((some[1:] + some[:-1]) / 2)
    return edges


def _to_blocks(edges: list[np.ndarray], block_rows: int):
    def block(number: int, rows: pa.Table) -> pa.RecordBatch:
        n = len(rows)
        values = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, len(edges))
        x = np.empty((len(edges), n), np.uint8)
        for f, e in enumerate(edges):
            x[f] = np.searchsorted(e, values[:, f], side="left")
        y = rows.column("label").to_numpy().astype(np.float64)
        week = rows.column("week").to_numpy().astype(np.int32)
        columns = [[number], [n], [x.tobytes()], [y.tobytes()], [week.tobytes()], [rows.column("mark").to_numpy().tobytes()], [np.zeros(n).tobytes()]]
        kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in _BLOCK.split(", ")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            while len(batch):
                some = batch.slice(0, block_rows - size)
                batch = batch.slice(len(some))
                held.append(some)
                size += len(some)
                if size == block_rows:
                    yield block(part * 4096 + number, pa.Table.from_batches(held))
                    number, held, size = number + 1, [], 0
        if size:
            yield block(part * 4096 + number, pa.Table.from_batches(held))

    return work


def bin_rows(rows: DataFrame, keys: Sequence[str] = ("Store", "Date"), block_rows: int = BLOCK_ROWS) -> Binned:
    """rows: features, label, the week key and `keys`, by which the rows are dealt and sorted."""
    parts = max(1, math.ceil(rows.count() / block_rows))
    edges = thresholds(rows)
    plain = rows.repartition(parts, *keys).sortWithinPartitions(*keys)
    plain = plain.select(vector_to_array("features").alias("v"), F.col("label").cast("double").alias("label"), F.col(split.WEEK).cast("int").alias("week"), F.xxhash64(*keys).alias("mark"))
    path = scratch_path(rows.sparkSession, "binned")
    plain.mapInArrow(_to_blocks(edges, block_rows), _BLOCK).write.parquet(path)
    blocks = rows.sparkSession.read.schema(_BLOCK).parquet(path).persist(StorageLevel.MEMORY_AND_DISK)
    return Binned(blocks, blocks.count(), edges)


# --- one tree ---------------------------------------------------------------------------------------------


class Tree:
    """A complete binary tree as arrays: node i has the children 2 i + 1 and 2 i + 2. A leaf has feature -1."""

    def __init__(self, depth: int) -> None:
        n = (2 << depth) - 1
        self.feature, self.cut = np.full(n, -1, np.int16), np.zeros(n, np.int16)
        self.value, self.rows, self.gain = np.zeros(n), np.zeros(n, np.int64), np.zeros(n)

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at, every = np.zeros(x.shape[1], np.int64), np.arange(x.shape[1])
        while True:
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                return at
            right = x[np.maximum(feature, 0), every] > self.cut[at]
            at = np.where(inner, 2 * at + 1 + right, at)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.place(x)]


def _within(week: np.ndarray, weeks: Weeks) -> np.ndarray:
    return (week >= weeks[0]) & (week <= weeks[1])


def _sample(settings: BoostSettings, number: int, mark: np.ndarray) -> np.ndarray:
    """Rows of a round, by a hash of their keys, so that it makes no difference how rows lie in blocks."""
    with np.errstate(over="ignore"):
        h = mark ^ np.uint64(pow(settings.seed * 1_000_003 + number + 1, 3, 1 << 63))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53 < settings.row_fraction


def _features(settings: BoostSettings, number: int, n: int) -> np.ndarray:
    some = np.random.default_rng([settings.seed, number]).permutation(n)[: max(1, round(settings.feature_fraction * n))]
    return np.sort(some)


def node_sums(x: np.ndarray, rest: np.ndarray, at: np.ndarray, used: np.ndarray, nodes: np.ndarray, features: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(node, 2, bin of a feature): number of the used rows and sum of what is left over."""
    out = np.zeros((len(nodes), 2, offsets[-1]))
    rank = np.searchsorted(nodes, at)
    rank[rank == len(nodes)] = 0
    here = np.flatnonzero(used & (nodes[rank] == at))
    rank, rest = rank[here], rest[here]
    for f in features:
        lo, hi = offsets[f], offsets[f + 1]
        cell = rank * (hi - lo) + x[f, here]
        out[:, 0, lo:hi] = np.bincount(cell, minlength=len(nodes) * (hi - lo)).reshape(len(nodes), -1)
        out[:, 1, lo:hi] = np.bincount(cell, weights=rest, minlength=len(nodes) * (hi - lo)).reshape(len(nodes), -1)
    return out


def best_splits(sums: np.ndarray, settings: BoostSettings, features: np.ndarray, offsets: np.ndarray) -> list[tuple]:
    """For each node (gain, feature, cut, rows and sum of the left side, rows and sum of all); feature -1 where nothing is gained."""
    cells, owner = [], []
    for f in features:
        cuts = np.arange(offsets[f + 1] - offsets[f] - 1)
        if len(cuts) >= settings.bins:  # coarser bins: every so many thresholds
            cuts = np.unique(np.linspace(0, len(cuts) - 1, settings.bins - 1).round().astype(int))
        cells.append(offsets[f] + cuts)
        owner.append(np.full(len(cuts), f))
    cells, owner = np.concatenate(cells), np.concatenate(owner)
    running = np.concatenate([np.zeros((*sums.shape[:2], 1)), np.cumsum(sums, axis=2)], axis=2)
    first = features[0]
    n, total = (running[:, :, offsets[first + 1]] - running[:, :, offsets[first]]).T
    if not len(cells):
        return [(0.0, -1, 0, 0.0, 0.0, *rest) for rest in zip(n.tolist(), total.tolist())]
    sides = running[:, :, cells + 1] - running[:, :, offsets[owner]]
    left, part = np.round(sides[:, 0]), sides[:, 1]
    right, other = n[:, None] - left, total[:, None] - part
    gain = part**2 / np.maximum(left, 1) + other**2 / np.maximum(right, 1) - (total**2 / np.maximum(n, 1))[:, None]
    gain[(left < settings.min_rows) | (right < settings.min_rows)] = -1.0
    at = np.argmax(np.round(gain, 9), axis=1)
    out = []
    for node, k in enumerate(at.tolist()):
        some = (float(gain[node, k]), int(owner[k]), int(cells[k] - offsets[owner[k]]), float(left[node, k]), float(part[node, k]))
        out.append((*(some if some[0] > 1e-9 else (0.0, -1, 0, 0.0, 0.0)), float(n[node]), float(total[node])))
    return out


def _grow(tree: Tree, nodes: Sequence[int], splits: Sequence[tuple]) -> list[int]:
    """Puts the splits of a level into the tree; the nodes of the next one."""
    fresh = []
    for node, (gain, feature, cut, left, part, n, total) in zip(nodes, splits):
        tree.rows[node], tree.value[node] = n, total / n if n else 0.0
        if feature >= 0:
            tree.feature[node], tree.cut[node], tree.gain[node] = feature, cut, gain / n
            for child, rows, share in ((2 * node + 1, left, part), (2 * node + 2, n - left, total - part)):
                tree.rows[child], tree.value[child] = rows, share / rows
                fresh.append(child)
    return fresh


class _Block:
    """A block's arrays in a task."""

    def __init__(self, batch: pa.RecordBatch, i: int) -> None:
        raw = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)
        self.number, self.n = batch.column("block")[i].as_py(), batch.column("n")[i].as_py()
        self.x = raw("x", np.uint8).reshape(-1, self.n)
        self.y, self.week, self.mark, self.score = raw("y", np.float64), raw("week", np.int32), raw("mark", np.uint64), raw("score", np.float64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for i in range(len(batch)):
            yield _Block(batch, i)


# --- boosting ---------------------------------------------------------------------------------------------


class Boosting:
    """Trees fitted so far on the weeks `train`, and the loss on the weeks `held` after each round.

    The sum starts from the mean of the training labels.
    """

    def __init__(self, table: Binned, settings: BoostSettings, train: Weeks = ALL_WEEKS, held: Weeks | None = None) -> None:
        self.table, self.settings, self.train, self.held = table, settings, train, held
        self.trees: list[Tree] = []
        self.losses: list[float] = []
        self.mean: float | None = None
        self.blocks, self.staged, self.path = table.blocks, 0, None

    @property
    def rounds(self) -> int:
        return len(self.trees)

    @property
    def best(self) -> int:
        """The round of least loss; without held-out weeks the last one."""
        return min(range(len(self.losses)), key=self.losses.__getitem__) + 1 if self.losses else self.rounds

    @property
    def finished(self) -> bool:
        waited = self.held is not None and self.losses and self.rounds - self.best >= self.settings.patience
        return bool(waited) or self.rounds >= self.settings.max_iter

    def advance(self, rounds: int) -> None:
        """Up to `rounds` more trees; fewer if the boosting is over before."""
        rounds = min(rounds, self.settings.max_iter - self.rounds)
        if self.finished:
            return
        if self.table.count == 1:
            self._in_one_task(rounds)
            return
        if self.mean is None:
            self.mean = self._mean()
        for _ in range(rounds):
            if self.finished:
                return
            self._round()
            if self.rounds - self.staged >= STAGE_ROUNDS:
                self._stage()

    def close(self) -> None:
        if self.path:
            remove_path(self.table.blocks.sparkSession, self.path)
            self.path, self.blocks, self.staged = None, self.table.blocks, 0

    # One block: all rounds in the task that holds it.

    def _in_one_task(self, rounds: int) -> None:
        settings, train, held, offsets = self.settings, self.train, self.held, self.table.offsets
        before, losses, mean = self.trees, self.losses, self.mean

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches):
                used, checked = _within(block.week, train), _within(block.week, held) if held else None
                start = mean if mean is not None else float(block.y[used].sum() / max(1, used.sum()))
                score = np.full(block.n, start)
                for tree in before:
                    score += settings.step * tree.predict(block.x)
                trees, now = [], list(losses)
                for number in range(len(before), len(before) + rounds):
                    rest, sampled = block.y - score, used & _sample(settings, number, block.mark)
                    features = _features(settings, number, len(offsets) - 1)
                    tree, nodes = Tree(settings.depth), [0]
                    for _ in range(settings.depth):
                        sums = node_sums(block.x, rest, tree.place(block.x), sampled, np.array(nodes), features, offsets)
                        nodes = _grow(tree, nodes, best_splits(sums, settings, features, offsets))
                        if not nodes:
                            break
                    score += settings.step * tree.predict(block.x)
                    trees.append(tree)
                    if held:
                        now.append(float(((block.y - score)[checked] ** 2).sum() / max(1, checked.sum())))
                        if len(now) - 1 - int(np.argmin(now)) >= settings.patience:
                            break
                made = pickle.dumps((start, trees, now))
                yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([made], pa.binary())], names=["node", "best"])

        for row in self.table.blocks.mapInArrow(work, _BEST).collect():
            self.mean, trees, self.losses = pickle.loads(row["best"])
            self.trees = self.trees + trees

    # Several blocks: a job for each level.

    def _mean(self) -> float:
        train = self.train

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches):
                used = _within(block.week, train)
                yield pa.RecordBatch.from_arrays([pa.array([float(block.y[used].sum())]), pa.array([int(used.sum())])], names=["s", "n"])

        total, n = self.table.blocks.mapInArrow(work, "s double, n long").agg(F.sum("s"), F.sum("n")).first()
        return (total or 0.0) / max(1, n or 0)

    def _scorer(self) -> Callable[[_Block], np.ndarray]:
        start, since, step = self.mean if self.staged == 0 else 0.0, self.trees[self.staged :], self.settings.step

        def score(block: _Block) -> np.ndarray:
            out = block.score + start
            for tree in since:
                out += step * tree.predict(block.x)
            return out

        return score

    def _round(self) -> None:
        number, tree, nodes = self.rounds, Tree(self.settings.depth), [0]
        for _ in range(self.settings.depth):
            found = self._level(number, tree, np.array(nodes))
            nodes = _grow(tree, nodes, [found[k] for k in nodes])
            if not nodes:
                break
        self.trees.append(tree)
        if self.held is not None:
            self.losses.append(self._loss())

    def _level(self, number: int, tree: Tree, nodes: np.ndarray) -> dict[int, tuple]:
        settings, train, offsets, score = self.settings, self.train, self.table.offsets, self._scorer()
        features = _features(settings, number, len(offsets) - 1)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = None
            for block in _blocks(batches):
                sampled = _within(block.week, train) & _sample(settings, number, block.mark)
                some = node_sums(block.x, block.y - score(block), tree.place(block.x), sampled, nodes, features, offsets)
                sums = some if sums is None else sums + some
            if sums is not None:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int32()), pa.array([s.tobytes() for s in sums], pa.binary())], names=["node", "sums"])

        def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def done() -> pa.RecordBatch:
                best = pickle.dumps(best_splits(sums.reshape(1, 2, -1), settings, features, offsets)[0])
                return pa.RecordBatch.from_arrays([pa.array([node], pa.int32()), pa.array([best], pa.binary())], names=["node", "best"])

            node, sums = None, None
            for batch in batches:
                for i in range(len(batch)):
                    one, part = batch.column(0)[i].as_py(), np.frombuffer(batch.column(1)[i].as_buffer())
                    if node is not None and one != node:
                        yield done()
                        sums = None
                    node, sums = one, part.copy() if sums is None else sums + part
            if node is not None:
                yield done()

        parts = self.blocks.mapInArrow(partial, _SUMS).repartition("node").sortWithinPartitions("node")
        return {r["node"]: pickle.loads(r["best"]) for r in parts.mapInArrow(merged, _BEST).collect()}

    def _loss(self) -> float:
        return self.error(self.held, lambda label, score: (label - score) ** 2)

    def error(self, weeks: Weeks, terms: Callable[[np.ndarray, np.ndarray], np.ndarray], rounds: int | None = None) -> float:
        """Mean of `terms`(label, prediction) over the rows of some weeks, after the first `rounds` rounds (all by default)."""
        if rounds is None or rounds >= self.rounds:
            blocks, score = self.blocks, self._scorer()
        else:
            blocks, mean, trees, step = self.table.blocks, self.mean, self.trees[:rounds], self.settings.step
            score = lambda block: mean + step * sum((t.predict(block.x) for t in trees), np.zeros(block.n))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches):
                checked = _within(block.week, weeks)
                total = float(terms(block.y[checked], score(block)[checked]).sum())
                yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([int(checked.sum())])], names=["s", "n"])

        total, n = blocks.mapInArrow(work, "s double, n long").agg(F.sum("s"), F.sum("n")).first()
        return (total or 0.0) / max(1, n or 0)

    def _stage(self) -> None:
        """Writes the blocks with the sum of all trees so far; the folder before is not needed any more."""
        score = self._scorer()

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(batch)):
                    made = pa.array([score(_Block(batch, i)).tobytes()], pa.binary())
                    one = batch.slice(i, 1)
                    yield one.set_column(one.schema.get_field_index("score"), "score", made)

        spark, path = self.table.blocks.sparkSession, scratch_path(self.table.blocks.sparkSession, "boosting")
        self.blocks.mapInArrow(work, _BLOCK).write.parquet(path)
        old, self.path = self.path, path
        self.blocks, self.staged = spark.read.schema(_BLOCK).parquet(path), self.rounds
        if old:
            remove_path(spark, old)

    # The model in Spark's own form.

    def model(self, rounds: int | None = None) -> GBTRegressionModel:
        """The model of the first `rounds` rounds (the best ones by default), the mean being its first tree."""
        path = scratch_path(self.table.blocks.sparkSession, "boosted")
        write_model(self.table.blocks.sparkSession, path, self.mean or 0.0, self.trees[: self.best if rounds is None else rounds],
                    self.settings, self.table.edges)
        return GBTRegressionModel.load(path)


_NODES = pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()),
    ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
    ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])),
])


def _nodes(tree: Tree, edges: list[np.ndarray]) -> list[dict]:
    """The tree's nodes as Spark stores them: numbered by level, children after their parents."""
    order, k = [0], 0
    while k < len(order):
        if tree.feature[order[k]] >= 0:
            order += [2 * order[k] + 1, 2 * order[k] + 2]
        k += 1
    place, out = {node: k for k, node in enumerate(order)}, []
    for k, node in enumerate(order):
        n, value, f = int(tree.rows[node]), float(tree.value[node]), int(tree.feature[node])
        inner = f >= 0
        out.append({
            "id": k, "prediction": value, "impurity": 0.0, "impurityStats": [float(n), n * value, n * value * value], "rawCount": n,
            "gain": float(tree.gain[node]) if inner else -1.0, "leftChild": place[2 * node + 1] if inner else -1,
            "rightChild": place[2 * node + 2] if inner else -1,
            "split": {"featureIndex": f, "leftCategoriesOrThreshold": [float(edges[f][tree.cut[node]])] if inner else [], "numCategories": -1},
        })
    return out


def write_model(spark: SparkSession, path: str, mean: float, trees: Sequence[Tree], settings: BoostSettings, edges: list[np.ndarray]) -> None:
    """Stores the trees in the file layout of Spark's `GBTRegressionModel`."""
    first = Tree(0)
    first.value[0], first.rows[0] = mean, 1
    whole = [first, *trees]
    weights = [1.0] + [settings.step] * len(trees)
    given = {"maxDepth": settings.depth, "maxIter": len(whole), "stepSize": settings.step, "seed": settings.seed}
    usual = {"impurity": "variance", "featuresCol": "features", "labelCol": "label", "predictionCol": "prediction"}

    def head(kind: str, uid: str, params: dict, **more: object) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": 0, "sparkVersion": spark.version, "uid": uid,
                           "paramMap": params, "defaultParamMap": usual, **more})

    top = head("GBTRegressionModel", "boosted_trees", given, numFeatures=len(edges), numTrees=len(whole))
    spark.createDataFrame([(top,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    heads = [(k, head("DecisionTreeRegressionModel", f"tree_{k}", {}), w) for k, w in enumerate(weights)]
    spark.createDataFrame(heads, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    rows = [(k, node) for k, tree in enumerate(whole) for node in _nodes(tree, edges)]
    table = pa.table({"treeID": pa.array([k for k, _ in rows], pa.int32()), "nodeData": pa.array([n for _, n in rows], _NODES)})
    spark.createDataFrame(table).write.parquet(f"{path}/data")


def fit_with_stop(table: Binned, train: Weeks, held: Weeks, settings: BoostSettings) -> Boosting:
    """A boosting on the weeks `train` that went on until `patience` rounds did nothing for the weeks `held`."""
    run = Boosting(table, settings, train, held)
    run.advance(settings.max_iter)
    run.close()
    return run


def fit_rounds(table: Binned, settings: BoostSettings, rounds: int, train: Weeks = ALL_WEEKS) -> Boosting:
    """A boosting of a fixed number of rounds."""
    run = Boosting(table, replace(settings, max_iter=max(rounds, 1)), train)
    run.advance(rounds)
    run.close()
    return run


# --- search -----------------------------------------------------------------------------------------------

# The search space, as (low, high).
SEARCH_SPACE = {
    "depth": (6, 8),
    "bins": (63, 255),
    "step": (0.01, 0.05),
    "min_rows": (100, 500),
    "row_fraction": (0.7, 0.95),
    "feature_fraction": (0.7, 0.95),
}


def sample_settings(rng: random.Random, base: BoostSettings) -> BoostSettings:
    low, high = (math.log(v) for v in SEARCH_SPACE["step"])
    return replace(
        base,
        depth=rng.randint(*SEARCH_SPACE["depth"]),
        bins=rng.randint(*SEARCH_SPACE["bins"]),
        step=math.exp(rng.uniform(low, high)),
        min_rows=rng.randint(*SEARCH_SPACE["min_rows"]),
        row_fraction=rng.uniform(*SEARCH_SPACE["row_fraction"]),
        feature_fraction=rng.uniform(*SEARCH_SPACE["feature_fraction"]),
    )


@dataclass
class Trial:
    number: int
    settings: BoostSettings
    scores: list[float] = field(default_factory=list)  # by fold, at the last comparison
    iterations: list[int] = field(default_factory=list)  # best round by fold
    rounds: list[int] = field(default_factory=list)  # rounds fitted by fold
    pruned: bool = False

    @property
    def score(self) -> float:
        return statistics.fmean(self.scores) if self.scores else math.inf


def race(
    table: Binned, folds: Sequence[tuple[list[int], list[int]]], trials: Sequence[Trial], terms: Callable[[np.ndarray, np.ndarray], np.ndarray],
    rung: int = RUNG_ROUNDS, parallel: int = 8,
) -> list[Trial]:
    """All trials go through all folds side by side, `rung` rounds at a time; the finished ones come first, best first.

    After each rung the running trials that are worse than the median of all that are still in the race are dropped; no fold is
    fitted again. Driver threads only submit Spark jobs. terms: the errors of rows by label and prediction; their mean on a
    fold's later weeks, at its best round, is its score.
    """
    ends = [((t[0], t[-1]), (v[0], v[-1])) for t, v in folds]  # weeks are consecutive, so a fold is two ranges
    runs = {(k, f): Boosting(table, t.settings, *ends[f]) for k, t in enumerate(trials) for f in range(len(folds))}
    scores: dict[tuple[int, int], float] = {}

    def step(place: tuple[int, int]) -> float:
        run = runs[place]
        before = run.best if run.rounds else -1
        run.advance(rung)
        return scores[place] if place in scores and run.best == before else run.error(ends[place[1]][1], terms, run.best)

    racing = list(range(len(trials)))
    spark = table.blocks.sparkSession
    try:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            while racing:
                places = [(t, f) for t in racing for f in range(len(folds))]
                scores.update(zip(places, pool.map(inheritable_thread_target(spark)(step), places)))
                for t in racing:
                    mine = [runs[t, f] for f in range(len(folds))]
                    trials[t].scores = [scores[t, f] for f in range(len(folds))]
                    trials[t].iterations, trials[t].rounds = [r.best for r in mine], [r.rounds for r in mine]
                running = [t for t in racing if not all(runs[t, f].finished for f in range(len(folds)))]
                limit = statistics.median(t.score for t in trials if not t.pruned)
                for t in running:
                    trials[t].pruned = trials[t].score > limit
                racing = [t for t in running if not trials[t].pruned]
    finally:
        for run in runs.values():
            run.close()
    return sorted(trials, key=lambda t: (t.pruned, t.score, t.number))
