"""Spelling variants: words one edit apart, found by a frontier of states that moves down a trie held as a table of edges.

A state is (word, position, node, edits): so much of the word read, at this node of the trie of all words, with no or one edit spent.
States without an edit stand on the word's own path. From there a state may go on with another character than the word's next
one, as a replacement or as an inserted character; then it only follows edges that the rest of the word spells, one join of
the frontier with the edge table for each level. A state whose word is read where another word ends makes the two neighbours.
A deletion is an insertion seen from the other word, and of two words that differ in one character the one with the larger one
finds the other.

Edits near the root would take every word to every first letter. So there are two tries, of the words and of the reversed
words, and edits are made in the second half of what is read only: of two words one edit apart the first halves are equal, or the
last ones. A word enters a trie at that depth. Paths without branches are one edge with a label, so the number of levels follows
the branches, not the length of words, and a very long word costs its length once. Nodes are told by 124 bits of prefix hashes,
labels are compared as text.

Every table is a join or sum by node or word; nothing is kept per task but the words of a batch. A word's neighbours are summed up
on the map side, so one with very many is no hot group. Null texts have no words; a null id is written as an empty text. Extra columns
don't matter; repeated rows count again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.registry import staged

RUN = "[A-Za-zÀ-ÿ]+"
TYPO_IN = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
LEAST_RATIO = 2
BATCH_CHARS = 1 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
_BASES = (1103515245, 1220703125, 1540483477, 1999999973)


def with_typos(run: Column, doc_id: Column, typo_in: int = TYPO_IN) -> Column:
    """The run, or the run without one character where `typo_in` divides the checksum of `<doc_id>:<run>`."""
    check = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (check % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(check % typo_in == 0, shorter).otherwise(run)


def word_counts(df: DataFrame, doc_id: str, text: str, typo_in: int = TYPO_IN, length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of at least `length` characters that occur `count` times or more."""
    runs = F.regexp_extract_all(text, F.lit(RUN), F.lit(0))
    words = df.select(F.col(doc_id).alias("_id"), F.explode(runs).alias("run")).where(F.length("run") >= length)
    plain = F.octet_length("run") == F.length("run")  # only A-Z change, so lower() serves where there is nothing else
    words = words.select("_id", F.when(plain, F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER)).alias("run"))
    words = words.select(with_typos(F.col("run"), F.col("_id"), typo_in).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") >= count) & (F.length("word") >= length))


_PATH = "id long, way int, size int, depth int, a long, b long, next int"
_PATH_NAMES = [f.split()[0] for f in _PATH.split(", ")]


def _powers(n: int, base: int, prime: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        step = np.uint64(pow(base, len(out), prime))
        out = np.concatenate([out, out * step % np.uint64(prime)])
    return out[:n]


def prefix_hashes(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 62-bit hashes of every prefix (lengths 0 to n) of words that lie one after the other; n + 1 places for a word."""
    sizes = np.diff(bounds)
    rank = np.arange(len(codes)) - np.repeat(bounds[:-1], sizes)
    place = np.arange(len(codes)) + np.repeat(np.arange(len(sizes)), sizes) + 1
    start = np.repeat((bounds[:-1] + np.arange(len(sizes))), sizes + 1)
    parts = []
    for prime, base in zip(_PRIMES, _BASES):
        terms = np.zeros(len(codes) + len(sizes), np.uint64)
        terms[place] = codes.astype(np.uint64) * _powers(int(sizes.max(initial=0)), base, prime)[rank] % np.uint64(prime)
        sums = np.cumsum(terms)
        parts.append((sums - sums[start]) % np.uint64(prime))
    join = lambda x, y: ((x << np.uint64(31)) | y).view(np.int64)
    return join(parts[0], parts[1]), join(parts[2], parts[3])


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, way, word) -> the word's nodes from its entry on: depth, hashes, next character (0 at the end)."""
    for batch in batches:
        words = batch.column(2).to_pylist()
        sizes = np.array([len(w) for w in words], np.int64)
        ends, lo = np.cumsum(sizes), 0
        while lo < len(words):
            before = ends[lo] - sizes[lo]
            hi = max(lo + 1, int(np.searchsorted(ends, before + BATCH_CHARS, side="right")))
            some = sizes[lo:hi]
            codes = np.frombuffer("".join(words[lo:hi]).encode("utf-32-le"), np.uint32)
            bounds = np.concatenate([[0], np.cumsum(some)])
            a, b = prefix_hashes(codes, bounds)
            way = batch.column(1).to_numpy()[lo:hi].astype(np.int64)
            entry = np.where(way == 0, (some - 1) // 2, some // 2)
            many = some - entry + 1
            word = np.repeat(np.arange(hi - lo), many)
            depth = entry[word] + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            at = bounds[word] + word + depth
            following = np.append(codes, 0)[bounds[word] + depth].astype(np.int32)
            following[depth == some[word]] = 0
            # The two tries have no node in common.
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, hi - lo).take(pa.array(word)), pa.array(way[word].astype(np.int32)), pa.array(some[word].astype(np.int32)),
                    pa.array(depth.astype(np.int32)), pa.array(a[at] * 2 + way[word]), pa.array(b[at]), pa.array(following),
                ],
                names=_PATH_NAMES,
            )
            lo = hi


def neighbours(words: DataFrame) -> DataFrame:
    """(id, near): both directions of all pairs of (id, word) one edit apart. Words are different and not empty."""
    ways = words.select("id", F.lit(0).alias("way"), "word").unionByName(words.select("id", F.lit(1).alias("way"), F.reverse("word").alias("word")))
    paths = staged(ways.mapInArrow(_paths, _PATH), "paths")
    branches = paths.groupBy("a", "b").agg(F.min("next").alias("low"), F.max("next").alias("high")).where("low <> high").select("a", "b")
    marked = paths.join(branches.withColumn("branch", F.lit(True)), ["a", "b"], "left")
    kept = marked.where("branch or next = 0")
    along = Window.partitionBy("id", "way").orderBy("depth")
    kept = kept.select("*", *[F.lead(c).over(along).alias(f"to_{c}") for c in ("depth", "a", "b")])
    kept = staged(kept.join(ways, ["id", "way"]), "kept")
    ends = kept.where("next = 0").select(F.col("a").alias("to_a"), F.col("b").alias("to_b"), F.col("id").alias("ends"))
    label = F.substring("word", F.col("depth") + 1, F.col("to_depth") - F.col("depth"))
    edges = kept.where("branch and next > 0").select("a", "b", "next", label.alias("label"), "to_a", "to_b")
    edges = edges.dropDuplicates(["a", "b", "next"]).withColumnRenamed("next", "char").join(ends, ["to_a", "to_b"], "left")
    # What a node goes on with, to be looked at before a state is sent there.
    heads = edges.groupBy(F.col("a").alias("to_a"), F.col("b").alias("to_b")).agg(F.collect_set("char").alias("heads"))
    edges = staged(edges.join(heads, ["to_a", "to_b"], "left"), "edges")
    # The first level: states without an edit meet all edges of their node but their own.
    half = F.floor(F.col("size") / 2)
    states = kept.where("branch").where(F.col("depth") >= F.when(F.col("way") == 0, half).otherwise(F.col("size") - half))
    states = states.select("id", "a", "b", "next", F.expr("substring(word, depth + 1)").alias("rest"))
    met = states.join(edges, ["a", "b"]).where("char <> next")
    tail = F.expr("substring(label, 2)")
    inserted = _spelled(F.col("rest"), tail)
    replaced = F.when((F.col("next") > 0) & (F.col("char") < F.col("next")), _spelled(F.expr("substring(rest, 2)"), tail))
    frontier = _at_ends(met.select("id", "to_a", "to_b", "ends", F.explode(F.array_compact(F.array(inserted, replaced))).alias("rest")))
    found = None
    while True:
        frontier = staged(frontier, "frontier")
        done = frontier.where("rest = '' and ends is not null").select("id", F.col("ends").alias("near"))
        found = done if found is None else found.unionByName(done)
        open_ = frontier.where("rest <> ''").select("id", "a", "b", "rest", F.ascii("rest").alias("char"))
        if open_.isEmpty():
            break
        met = open_.join(edges, ["a", "b", "char"]).withColumn("rest", _spelled(F.col("rest"), F.col("label")))
        frontier = _at_ends(met.where("rest is not null"))
    pairs = staged(found.distinct(), "pairs")
    return pairs.unionByName(pairs.select(F.col("near").alias("id"), F.col("id").alias("near")))


def _spelled(rest: Column, label: Column) -> Column:
    """What is left of `rest` behind the label, null if it doesn't spell the label or can't go on from the edge's end."""
    left = F.substring(rest, F.length(label) + 1, F.length(rest))
    goes_on = F.when(F.length(rest) == F.length(label), F.col("ends").isNotNull()).otherwise(F.array_contains("heads", F.ascii(left)))
    return F.when(F.startswith(rest, label) & goes_on, left)


def _at_ends(met: DataFrame) -> DataFrame:
    return met.select("id", F.col("to_a").alias("a"), F.col("to_b").alias("b"), "ends", "rest")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last one, two steps become one in each round. No form leads in a circle."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        above = now.select(F.col("word").alias("root"), F.col("root").alias("above"))
        further = staged(now.join(above, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.isnotnull("above").alias("moved")), "roots")
        now = further.select("word", "root")
        if further.where("moved").isEmpty():
            return now


def groups(words: DataFrame, ratio: int = LEAST_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n).

    A word's form is its neighbour of largest n (equal ones: the first in code-point order) if that is `ratio` times its own n or more.
    """
    listed = staged(words.withColumn("id", F.monotonically_increasing_id()), "words")
    pairs = neighbours(listed.select("id", "word"))
    named = listed.select(F.col("id").alias("near"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    best = F.min(F.struct((-F.col("form_n")).alias("order"), "form"))
    near = pairs.join(named, "near").groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    out = listed.join(near, "id", "left").withColumn("_n", -F.col("best.order"))
    given = F.col("_n") >= ratio * F.col("n")
    out = staged(out.select("word", F.when(given, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                            F.when(given, F.col("_n")).alias("form_n")), "forms")
    last = roots(out.where("form is not null"))
    return out.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
