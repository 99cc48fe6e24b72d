"""Suffix arrays by induced sorting, and permuted common prefixes, with NumPy.

The scans of induced sorting go bucket by bucket: all suffixes of a bucket that are known so far pass their predecessors on at once,
in order, to the ends of their buckets; what falls into the same bucket is the next generation. So a scan takes a few array
operations for each byte value, not one step for each suffix. The names of the leftmost-smaller substrings are sorted by the same
recursion at every size; their string has so many different values that its scans go suffix by suffix instead.
"""

from __future__ import annotations

import numpy as np


def _types(s: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than the next one. The last one (a unique smallest value) is."""
    n = len(s)
    rise = np.zeros(n, np.int8)
    rise[:-1] = np.sign(s[1:].astype(np.int64) - s[:-1].astype(np.int64))
    rise[-1] = 1
    at = np.where(rise != 0, np.arange(n), n)
    return rise[np.minimum.accumulate(at[::-1])[::-1]] > 0


def _deal(array: np.ndarray, ends: np.ndarray, s: np.ndarray, items: np.ndarray, step: int) -> None:
    """Puts items, in order, at the open ends of their buckets."""
    values = s[items]
    order = np.argsort(values, kind="stable")
    counts = np.bincount(values, minlength=len(ends))
    first = np.cumsum(counts) - counts
    values = values[order]
    rank = np.arange(len(items)) - first[values]
    array[ends[values] + step * rank] = items[order]
    ends += step * counts


def _induce(s: np.ndarray, small: np.ndarray, sizes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The suffix array that `seeds`, leftmost-smaller suffixes in some order, induce."""
    n, starts = len(s), np.cumsum(sizes) - sizes
    array = np.full(n, -1, np.int64)
    tails = starts + sizes - 1
    seed_tails = tails.copy()
    _deal(array, seed_tails, s, seeds[::-1], -1)
    heads = starts.copy()
    some = np.flatnonzero(sizes)
    for c in some:
        done = starts[c]
        while done < heads[c]:
            items = array[done : heads[c]]
            done = heads[c]
            items = items[items > 0] - 1
            items = items[~small[items]]
            _deal(array, heads, s, items, 1)
        items = array[seed_tails[c] + 1 : tails[c] + 1]
        items = items[items > 0] - 1
        _deal(array, heads, s, items[~small[items]], 1)
    ends = tails.copy()
    for c in some[::-1]:
        done = tails[c]
        while done > ends[c]:
            items = array[ends[c] + 1 : done + 1][::-1]
            done = ends[c]
            items = items[items > 0] - 1
            _deal(array, ends, s, items[small[items]], -1)
        items = array[starts[c] : heads[c]][::-1]
        items = items[items > 0] - 1
        _deal(array, ends, s, items[small[items]], -1)
    return array


def _induce_by_step(s: np.ndarray, small: np.ndarray, sizes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The same, suffix by suffix with a counter for each bucket: for strings of very many different values."""
    n, values, rising = len(s), s.tolist(), small.tolist()
    array, ends = [-1] * n, np.cumsum(sizes).tolist()
    for i in seeds[::-1].tolist():
        ends[values[i]] -= 1
        array[ends[values[i]]] = i
    heads = (np.cumsum(sizes) - sizes).tolist()
    for k in range(n):
        i = array[k] - 1
        if i >= 0 and not rising[i]:
            v = values[i]
            array[heads[v]] = i
            heads[v] += 1
    ends = np.cumsum(sizes).tolist()
    for k in range(n - 1, -1, -1):
        i = array[k] - 1
        if i >= 0 and rising[i]:
            ends[values[i]] -= 1
            array[ends[values[i]]] = i
    return np.array(array, np.int64)


_STEP_COST = 64  # suffixes taken one by one cost as much as one bucket taken whole


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of all suffixes of s, whose last value is its unique smallest one."""
    n = len(s)
    if n < 3:
        return np.arange(n)[::-1].copy()
    sizes = np.bincount(s)
    small = _types(s)
    lead = np.zeros(n, bool)
    lead[1:] = small[1:] & ~small[:-1]
    seeds = np.flatnonzero(lead)
    induce = _induce if np.count_nonzero(sizes) * _STEP_COST <= n else _induce_by_step
    array = induce(s, small, sizes, seeds)
    placed = array[lead[array]]
    # Equal leftmost-smaller substrings get one name.
    length = np.zeros(n, np.int64)
    length[seeds[:-1]] = np.diff(seeds) + 1
    length[seeds[-1]] = 1
    a, b = placed[:-1], placed[1:]
    differ = length[a] != length[b]
    open_, step = np.flatnonzero(~differ), 0
    while len(open_):
        unequal = s[a[open_] + step] != s[b[open_] + step]
        differ[open_[unequal]] = True
        open_ = open_[~unequal]
        step += 1
        open_ = open_[step < length[a[open_]]]
    name = np.concatenate([[0], np.cumsum(differ)])
    if name[-1] + 1 < len(placed):
        names = np.zeros(n, np.int64)
        names[placed] = name
        reduced = names[seeds]
        placed = seeds[suffix_array(reduced)]
    return induce(s, small, sizes, placed)


def permuted_prefixes(s: np.ndarray, array: np.ndarray) -> np.ndarray:
    """Length of the prefix that each suffix shares with the one before it in the array, by text position.

    Only where the values before both suffixes differ it is counted; elsewhere it is one less than at the position before.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    at = np.arange(n)
    count = (before <= 0) | (at == 0)
    inner = np.flatnonzero(~count)
    count[inner] = s[inner - 1] != s[before[inner] - 1]
    length = np.zeros(n, np.int64)
    open_ = np.flatnonzero(count & (before >= 0))
    wide = np.concatenate([s.astype(np.uint8) if s.dtype == np.uint8 else s, np.zeros(8, s.dtype)])
    if s.dtype == np.uint8:
        words = np.ndarray(n, np.uint64, wide, strides=(1,))  # 8 bytes from every position
        while len(open_):
            a, b = open_ + length[open_], before[open_] + length[open_]
            inside = np.maximum(a, b) + 8 <= n
            same = inside.copy()
            same[inside] = words[a[inside]] == words[b[inside]]
            length[open_[same]] += 8
            if not same.any():
                break
            open_ = open_[same]
        open_ = np.flatnonzero(count & (before >= 0))
    while len(open_):
        a, b = open_ + length[open_], before[open_] + length[open_]
        same = np.maximum(a, b) < n
        same[same] = s[a[same]] == s[b[same]]
        open_ = open_[same]
        length[open_] += 1
    last = np.maximum.accumulate(np.where(count, at, 0))
    return length[last] - (at - last)
