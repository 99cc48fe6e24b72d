"""Verbatim benchmark passages in training text, by suffix arrays over shards of the training words.

A shard is a slice of a task's documents. Its words become ids in the benchmark's vocabulary (0: a word that no item
has, or the end of a document). The suffix array of a shard orders its word suffixes; a suffix whose first two words
are no pair of the benchmark can match nothing and is left out. Every distinct window of a benchmark item is then
binary-searched in the array, which gives all its locations at once, and the suffixes found are compared on to get
the longest verbatim matches. A document lies whole in one shard, so its result needs no shuffle.

The benchmark is sent to the tasks in blocks of bounded size. With more than one block, each is searched in turn and
the hits are joined by row.

A window is `size` consecutive words of an item; an item of fewer words, but not none, is one window. Null or empty
texts and items have no words. Items of equal id count once; an item without an id is found but listed as "". Extra
columns pass through; a column called like an output is replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.arrowmap import lists, over_texts
from daybook.llm.byteops import flat, gram_hashes, lower, word_hashes, words
from daybook.llm.registry import filtered, staged

SIZE = 10
BLOCK_BYTES = 16 << 20

#: Bytes of words after lowering A-Z: digits, letters and all that is not ASCII.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True

_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_MATCH = T.ArrayType(
    T.StructType([T.StructField("item", T.StringType()), T.StructField("start", T.LongType()), T.StructField("words", T.LongType())])
)
OUTPUT = {
    "n_words": T.LongType(),
    "n_hit": T.LongType(),
    "hits": _SPAN,
    "matches": _MATCH,
    "longest": T.LongType(),
    "items": T.ArrayType(T.StringType()),
}


def _words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the n + 1 bounds by text."""
    raw, bounds = flat(column)
    raw = lower(raw)
    starts, ends, by_text = words(raw, bounds, WORD)
    return word_hashes(raw, starts, ends), by_text


class Words:
    """Word ids with a 0 after each text, and `pack` of them at a time as one sortable key."""

    def __init__(self, ids: np.ndarray, by_text: np.ndarray, bits: int, pack: int):
        n = len(by_text) - 1
        counts = np.diff(by_text)
        self.shift = np.repeat(np.arange(n), counts)
        self.ids = np.zeros(len(ids) + n + 2 * pack, np.int64)
        self.ids[np.arange(len(ids)) + self.shift] = ids
        self.bits, self.pack = bits, pack
        key = np.zeros(len(self.ids) - pack, np.int64)
        for k in range(pack):
            key = key << bits | self.ids[k : k + len(key)]
        self.keys = key

    def key(self, at: np.ndarray, used: np.ndarray | int) -> np.ndarray:
        """The first `used` words from each position; positions beyond the end read as 0."""
        found = np.where(at < len(self.keys), self.keys[np.minimum(at, len(self.keys) - 1)], 0)
        return found >> (self.bits * (self.pack - used))


class Benchmark:
    """A block of items: its words, distinct windows, and which items have them."""

    def __init__(self, ids: list[str], texts: pa.Array, size: int):
        hashes, by_text = _words_of(texts)
        self.vocabulary = np.unique(hashes)
        self.bits = max(1, int(len(self.vocabulary)).bit_length())
        self.pack = max(1, min(4, 62 // self.bits))
        self.words = Words(np.searchsorted(self.vocabulary, hashes) + 1, by_text, self.bits, self.pack)
        counts = np.diff(by_text)
        width = np.minimum(counts, size)
        n_windows = np.where(counts > 0, counts - width + 1, 0)
        item = np.repeat(np.arange(len(counts)), n_windows)
        inside = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        start, width = by_text[:-1][item] + inside, width[item]
        content = np.zeros(len(start), np.uint64)
        for w in np.unique(width):
            content[width == w] = gram_hashes(hashes, start[width == w], int(w)) + np.uint64(w)
        order = np.argsort(content, kind="stable")
        _, first = np.unique(content[order], return_index=True)
        self.item, self.start = item[order], start[order] + item[order]  # positions count the 0 after each text
        self.first, self.count = first, np.diff(np.append(first, len(order)))
        self.width = width[order][first]
        self.least = int(self.width.min()) if len(first) else 0
        self.longest = int(counts.max()) if len(counts) else 0
        self.labels = np.array(ids, dtype=object)
        w = self.words.ids
        self.pairs = np.unique(w[:-1] << self.bits | w[1:])

    def suffix_array(self, doc: Words) -> np.ndarray:
        """Positions of the suffixes that can match, in the order of their words (as far as the longest item goes)."""
        w = doc.ids
        at = np.flatnonzero(w[:-1] > 0)
        if self.least > 1:
            pair = w[at] << self.bits | w[at + 1]
            at = at[self.pairs[np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)] == pair]
        if not len(at):
            return at
        key = doc.key(at, self.pack)
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        last = (1 << self.bits) - 1
        tied = np.zeros(len(at), bool)
        group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        for depth in range(self.pack, self.longest, self.pack):
            same = group[1:] == group[:-1]
            tied[:] = False
            tied[1:] |= same
            tied[:-1] |= same
            tied &= (key & last) > 0  # beyond a 0 nothing can match
            rows = np.flatnonzero(tied)
            if not len(rows):
                break
            more = doc.key(at[rows] + depth, self.pack)
            inner = np.lexsort((more, group[rows]))
            at[rows], key[rows] = at[rows][inner], more[inner]
            split = np.zeros(len(at), bool)
            split[rows[1:]] = (more[inner][1:] != more[inner][:-1]) & (np.diff(rows) == 1)
            group = np.cumsum(np.concatenate([[0], (np.diff(group) != 0) | split[1:]]))
        return at

    def _bound(self, doc: Words, array: np.ndarray, start: np.ndarray, width: np.ndarray, upper: bool) -> np.ndarray:
        """Binary search of each window: the first suffix that is not below it (upper: that is above it)."""
        lo, hi = np.zeros(len(start), np.int64), np.full(len(start), len(array), np.int64)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            below, over = np.zeros(len(open_), bool), np.full(len(open_), upper)  # over: what an equal prefix counts as
            even = np.arange(len(open_))
            for depth in range(0, int(width.max()), self.pack):
                left = width[open_[even]] - depth
                even = even[left > 0]
                used = np.minimum(left[left > 0], self.pack)
                have = doc.key(array[mid[even]] + depth, used)
                want = self.words.key(start[open_[even]] + depth, used)
                below[even], over[even[have != want]] = have < want, False
                even = even[have == want]
            below |= over
            lo[open_[below]] = mid[below] + 1
            hi[open_[~below]] = mid[~below]

    def common(self, doc: Words, at: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Words that the suffixes at[i] and start[i] have in common."""
        length, even, step = np.zeros(len(at), np.int64), np.arange(len(at)), 0
        while len(even):
            a, b = at[even] + step, start[even] + step
            same = (a < len(doc.ids)) & (b < len(self.words.ids))
            same &= doc.ids[np.minimum(a, len(doc.ids) - 1)] == self.words.ids[np.minimum(b, len(self.words.ids) - 1)]
            same &= self.words.ids[np.minimum(b, len(self.words.ids) - 1)] > 0
            even = even[same]
            length[even] += 1
            step += 1
        return length

    def search(self, column: pa.Array) -> dict[str, pa.Array]:
        hashes, by_text = _words_of(column)
        n, counts = len(column), np.diff(by_text)
        at = np.searchsorted(self.vocabulary, hashes) if len(self.vocabulary) else np.zeros(len(hashes), np.int64)
        known = at < len(self.vocabulary)
        known[known] = self.vocabulary[at[known]] == hashes[known]
        doc = Words(np.where(known, at + 1, 0), by_text, self.bits, self.pack)
        array = self.suffix_array(doc) if len(self.first) else np.empty(0, np.int64)
        probe = self.start[self.first] if len(self.first) else np.empty(0, np.int64)
        if len(array):
            lo = self._bound(doc, array, probe, self.width, False)
            found = self._bound(doc, array, probe, self.width, True) - lo
        else:
            lo = found = np.zeros(len(probe), np.int64)
        window = np.repeat(np.arange(len(probe)), found)
        place = array[np.repeat(lo, found) + np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found)] if len(window) else array[:0]
        base = by_text[:-1] + np.arange(n)  # where each text begins in doc.ids
        row = np.searchsorted(base, place, side="right") - 1
        # Words under any window.
        cover = np.zeros(len(doc.ids) + 1, np.int64)
        np.add.at(cover, place, 1)
        np.add.at(cover, place + self.width[window] if len(window) else place, -1)
        covered = np.cumsum(cover) > 0
        edge = np.diff(np.concatenate([[0], covered.view(np.int8), [0]]))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        span_row = np.searchsorted(base, begin, side="right") - 1
        # Every item that has a found window, and its maximal matches.
        times = self.count[window] if len(window) else window
        which = np.repeat(np.arange(len(window)), times)
        entry = (np.repeat(self.first[window], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)) if len(window) else window
        item, start, spot = self.item[entry], self.start[entry], place[which]
        owner = row[which]
        pairs = np.unique(np.stack([owner, item], 1), axis=0) if len(owner) else np.empty((0, 2), np.int64)
        before = (spot > 0) & (start > 0)
        grown = before & (doc.ids[spot - 1] == self.words.ids[start - 1]) & (doc.ids[spot - 1] > 0)
        spot, start, item, owner = spot[~grown], start[~grown], item[~grown], owner[~grown]
        length = self.common(doc, spot, start)
        order = np.lexsort((item, spot, owner))
        spot, item, owner, length = spot[order], item[order], owner[order], length[order]
        longest = np.zeros(n, np.int64)
        np.maximum.at(longest, owner, length)
        hit = np.zeros(n, np.int64)
        np.add.at(hit, span_row, end - begin)
        return {
            "n_words": pa.array(counts.astype(np.int64)),
            "n_hit": pa.array(hit),
            "hits": lists(
                pa.StructArray.from_arrays([pa.array(begin - base[span_row]), pa.array(end - base[span_row])], ["start", "end"]),
                np.bincount(span_row, minlength=n),
            ),
            "matches": lists(
                pa.StructArray.from_arrays(
                    [pa.array(self.labels[item].tolist(), pa.string()), pa.array(spot - base[owner]), pa.array(length)],
                    ["item", "start", "words"],
                ),
                np.bincount(owner, minlength=n),
            ),
            "longest": pa.array(longest),
            "items": lists(pa.array(self.labels[pairs[:, 1]].tolist(), pa.string()), np.bincount(pairs[:, 0], minlength=n)),
        }


def _search_block(docs: DataFrame, block: DataFrame, text: str, size: int) -> DataFrame:
    rows = block.collect()  # a block of bounded bytes
    ids = ["" if r[0] is None else str(r[0]) for r in rows]
    shared = docs.sparkSession.sparkContext.broadcast((ids, [r[1] or "" for r in rows]))
    made: dict[int, Benchmark] = {}

    def work(column: pa.Array) -> dict[str, pa.Array]:
        if not made:
            made[0] = Benchmark(shared.value[0], pa.array(shared.value[1], pa.string()), size)
        return made[0].search(column)

    return over_texts(docs, text, OUTPUT, work)


def find_passages(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    size: int = SIZE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """`docs` with n_words, n_hit (words under a window), hits (their runs), matches (maximal ones), longest and items."""
    items = items.select(F.col(item_id).cast("string").alias("_id"), F.col(item_text).alias("_text"))
    total = items.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    if blocks == 1:
        return _distinct_items(_search_block(docs, items, text, size))
    rows = staged(docs.withColumn("_row", F.monotonically_increasing_id()), "passages")
    parts = [
        _search_block(rows.select("_row", text), items.where(F.pmod(F.xxhash64("_id", "_text"), F.lit(blocks)) == k), text, size)
        .where("n_hit > 0").select("_row", "hits", "matches", "longest", "items")
        for k in range(blocks)
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = found.groupBy("_row").agg(
        F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.array_sort(F.flatten(F.collect_list("matches"))).alias("matches"),
        F.max("longest").alias("longest"),
        F.flatten(F.collect_list("items")).alias("items"),
    )
    n_words = _search_block(rows.select("_row", text), items.limit(0), text, size).select("_row", "n_words")
    none = {c: F.coalesce(c, F.array().cast(T._parse_datatype_json_string(OUTPUT[c].json()))) for c in ("hits", "matches", "items")}
    out = rows.select([c for c in rows.columns if c not in OUTPUT]).join(n_words, "_row").join(found, "_row", "left").withColumns(none)
    merged = F.aggregate(
        "hits",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["end"], x["start"]))).cast("long").alias("n"),
            F.greatest(a["end"], x["end"]).alias("end"),
        ),
    )["n"]
    out = out.withColumns({"n_hit": merged, "longest": F.coalesce("longest", F.lit(0).cast("long"))}).drop("_row")
    return _distinct_items(out)


def _distinct_items(df: DataFrame) -> DataFrame:
    return df.withColumn("items", F.array_sort(F.array_distinct("items")))


def remove_contaminated(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The documents with no benchmark window in them, with their own columns only."""
    return filtered(docs, [*OUTPUT, "_row"], lambda df: find_passages(df, items, **settings).where("n_hit = 0"))
