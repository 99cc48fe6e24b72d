"""Texts of an Arrow batch as one flat byte array, and vectorized hashing over it.

Hashes are polynomial over uint64 with an odd base, so that the hash of any byte range or run of words comes from two
prefix sums. They are mixed before use as their low bits alone are weak.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
SLICE_BYTES = 1 << 20


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and the n + 1 bounds. A null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(bounds: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes each; a longer text is a range of its own."""
    lo, n = 0, len(bounds) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + most, side="right")) - 1)
        yield lo, hi
        lo = hi


_POWERS = np.ones(1, np.uint64)
_INVERSE = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """BASE ** 0 .. BASE ** n, kept and grown on demand."""
    global _POWERS
    if len(_POWERS) <= n:
        size = max(n + 1, 2 * len(_POWERS), 1 << 16)
        _POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, BASE, np.uint64)]), dtype=np.uint64)
    return _POWERS


def inverses(n: int) -> np.ndarray:
    """The same for the inverse of BASE modulo 2 ** 64."""
    global _INVERSE
    if len(_INVERSE) <= n:
        size = max(n + 1, 2 * len(_INVERSE), 1 << 16)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        _INVERSE = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, inverse, np.uint64)]), dtype=np.uint64)
    return _INVERSE


def prefix(values: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of values[t] * BASE ** t over i <= t < j."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * powers(len(values))[: len(values)], out=out[1:])
    return out


def ranges(p: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-free hash of values[start:end], from their prefix sums."""
    return (p[ends] - p[starts]) * inverses(len(p))[starts]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer, so that every output bit hangs on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def words(raw: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (maximal runs of bytes in the class `is_word`, cut at text ends): starts, ends, and the n + 1 bounds by text.

    A word never reaches into the next text.
    """
    mask = is_word[raw]
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    inner = bounds[1:-1]
    inner = inner[inner < len(raw)]
    first[inner] = mask[inner]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    inner = inner[inner > 0] - 1
    last[inner] = mask[inner]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes and length."""
    p = prefix(raw.astype(np.uint64) + np.uint64(1))
    return mix(ranges(p, starts, ends) + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Hash of `size` consecutive values from each position in `first`."""
    p = prefix(hashes)
    return mix(ranges(p, first, first + size))


def lower(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    return _LOWER[raw]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
