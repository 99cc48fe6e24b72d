"""Co-moment matrices of many columns: count, means and centred products of every pair, foldable and mergeable.

Each pair of columns counts the rows where both are known, so nulls leave a row out only for the pairs they concern.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SCHEMA = "m int, parts binary"
FAN_IN = 32  # tasks of the first merge
_ROWS = 8192
_NAMES = ["m", "parts"]

# n, mean of the row's column, centred products (a, b), centred squares of the row's column, each m x m over the pair's rows.
Parts = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def of_rows(values: np.ndarray, known: np.ndarray) -> Parts:
    """values: rows x m; unknown ones are ignored. A constant column has exactly 0 as its square."""
    start = np.where(known.any(axis=0), values[np.argmax(known, axis=0), np.arange(values.shape[1])], 0.0)
    x = np.where(known, values - start, 0.0)
    middle = x.sum(axis=0) / np.maximum(known.sum(axis=0), 1)
    x = np.where(known, x - middle, 0.0)
    mask = known.astype(float)
    n = mask.T @ mask
    sums = x.T @ mask
    some = np.maximum(n, 1.0)
    products = x.T @ x - sums * sums.T / some
    squares = (x * x).T @ mask - sums * sums / some
    return n, sums / some + (start + middle)[:, None], products, squares


def merged(p: Parts, q: Parts) -> Parts:
    n = p[0] + q[0]
    share = p[0] * q[0] / np.maximum(n, 1.0)
    gap = np.where(share > 0, q[1] - p[1], 0.0)
    mean = np.where(q[0] == 0, p[1], np.where(p[0] == 0, q[1], p[1] + gap * q[0] / np.maximum(n, 1.0)))
    return n, mean, p[2] + q[2] + gap * gap.T * share, p[3] + q[3] + gap * gap * share


def _pack(m: int, parts: Parts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([np.stack(parts).tobytes()], pa.binary())], names=_NAMES)


def fold(m: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (array of m doubles) -> one row of matrices per task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for lo in range(0, len(batch), _ROWS):
                cells = batch.column(0).slice(lo, _ROWS).flatten()
                known = np.asarray(cells.is_valid()).reshape(-1, m)
                part = of_rows(cells.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, m), known)
                total = part if total is None else merged(total, part)
        if total is not None:
            yield _pack(m, total)

    return work


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Parts]]:
    for batch in batches:
        for m, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield m, tuple(np.frombuffer(raw).reshape(4, m, m))


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for m, part in _unpack(batches):
        total = (m, part if total is None else merged(total[1], part))
    if total is not None:
        yield _pack(*total)


def correlations(columns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The merged matrices -> (a, b, corr) of all ordered pairs; none for a table without rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m, (_, _, products, squares) in _unpack(batches):
            spread = np.sqrt(squares * squares.T)
            known = (spread > 0) | np.isnan(spread)
            corr = products / np.where(known, spread, 1.0)
            corr[np.arange(m), np.arange(m)] = np.where(np.isnan(corr.diagonal()), np.nan, 1.0)
            a, b = np.repeat(np.arange(m), m), np.tile(np.arange(m), m)
            names = pa.array(columns)
            values = pa.array(corr.ravel(), mask=~known.ravel())
            yield pa.RecordBatch.from_arrays([names.take(pa.array(a)), names.take(pa.array(b)), values], names=["a", "b", "corr"])

    return work
