"""Quality by importance resampling: which documents look like the target rather than like the corpus as a whole.

Texts become word and word-pair features, hashed into a fixed number of buckets. Two generative models are counted over
them: the raw one over all documents, the target one over those labelled good (high quality and not toxic; at most
`most_targets` of them, the ones of smallest hash). A text's log weight is the sum over its features of
log target probability - log raw probability, both smoothed by the same pseudo-count; buckets whose counts differ by less than
`significance` standard deviations count as equal, as their ratio is noise. Resampling without replacement is Gumbel
top-k: a Gumbel variate of the document's id is added to its log weight and the k largest keys are kept. k is the number
of documents whose weight is at least that of all but a share of `lose` of the targets.

The k-th key is found by histograms of bounded size over staged keys, so nothing is sorted or collected whole; the raw
counts meet as sums per bucket. Rows that tie with the k-th key are all kept. Null and empty texts have weight 0 and are
judged like any other. Without targets all documents are kept. Rows with a null id share one Gumbel variate. Extra
columns pass through; a column called like an output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.arrowmap import over_texts, release
from daybook.llm.byteops import flat, lower, mix, slices, word_hashes
from daybook.llm.registry import filtered, staged

BITS = 18
MOST_TARGETS = 65_536
SIGNIFICANCE = 2.0
PSEUDO = 1.0
LOSE = 0.005

#: Kinds of bytes: 0 space and control, 1 letters and digits, 2 punctuation.
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = 2
_KIND[0x30:0x3A] = _KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _KIND[0x80:] = 1


def features(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words (runs of one kind of byte, A-Z lowered) and pairs of neighbours, and the row of each."""
    raw, bounds = flat(column)
    raw = lower(raw)
    kind = _KIND[raw]
    before, after = np.zeros(len(kind), np.uint8), np.zeros(len(kind), np.uint8)
    before[1:], after[:-1] = kind[:-1], kind[1:]
    before[bounds[:-1][bounds[:-1] < len(kind)]] = 0
    after[bounds[1:][bounds[1:] > 0] - 1] = 0
    starts, ends = np.flatnonzero((kind > 0) & (kind != before)), np.flatnonzero((kind > 0) & (kind != after)) + 1
    hashes = word_hashes(raw, starts, ends)
    row = np.repeat(np.arange(len(column)), np.diff(np.searchsorted(starts, bounds)))
    pairs = mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])
    inside = row[:-1] == row[1:]
    shift = np.uint64(64 - bits)
    buckets = np.concatenate([hashes >> shift, pairs[inside] >> shift]).astype(np.int64)
    return buckets, np.concatenate([row, row[:-1][inside]])


def count_features(df: DataFrame, text: str, target: str, bits: int) -> DataFrame:
    """(bucket, raw, target): counts over all rows, and over those where `target` holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, chosen = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in batches:
            texts, good = batch.column(0), np.array(batch.column(1).to_pylist(), bool)
            for lo, hi in slices(flat(texts)[1]):
                buckets, row = features(texts.slice(lo, hi - lo), bits)
                raw += np.bincount(buckets, minlength=1 << bits)
                chosen += np.bincount(buckets[good[lo:hi][row]], minlength=1 << bits)
        some = np.flatnonzero(raw)
        for lo in range(0, len(some), 1 << 16):
            part = some[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(raw[part]), pa.array(chosen[part])], ["bucket", "raw", "target"])
        release()

    counted = df.select(text, F.coalesce(target, F.lit(False)).alias("_good")).mapInArrow(count, "bucket long, raw long, target long")
    return counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratio(raw: np.ndarray, target: np.ndarray, pseudo: float, significance: float) -> np.ndarray:
    if not target.sum():
        return np.zeros(len(raw))
    expected = raw * (target.sum() / raw.sum())
    ratio = np.log((target + pseudo) / (expected + pseudo))
    return np.where(np.abs(target - expected) >= significance * np.sqrt(expected + 1), ratio, 0.0)


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = BITS,
    most_targets: int = MOST_TARGETS, pseudo: float = PSEUDO, significance: float = SIGNIFICANCE,
) -> tuple[np.ndarray, DataFrame]:
    """Log ratio of every bucket, and the ids of the targets."""
    good = labels.where("quality = 1 and toxic = 0 and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    good = staged(good.orderBy(F.xxhash64("_id"), "_id").limit(most_targets), "targets")  # bounded: sent to all tasks below
    marked = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(
        F.broadcast(good.withColumn("_target", F.lit(True))), "_id", "left"
    )
    counts = count_features(marked, "_text", "_target", bits).toArrow()  # at most a row per bucket
    raw, target = np.zeros(1 << bits), np.zeros(1 << bits)
    at = counts.column("bucket").to_numpy()
    raw[at], target[at] = counts.column("raw").to_numpy(), counts.column("target").to_numpy()
    return log_ratio(raw, target, pseudo, significance), good


def weigh(df: DataFrame, ratio: np.ndarray, text: str = "text", name: str = "log_weight") -> DataFrame:
    """`df` with the log weight of each whole text."""
    bits = int(len(ratio)).bit_length() - 1
    shared = df.sparkSession.sparkContext.broadcast(ratio)

    def work(column: pa.Array) -> dict[str, pa.Array]:
        buckets, row = features(column, bits)
        return {name: pa.array(np.bincount(row, weights=shared.value[buckets], minlength=len(column)).astype(float))}

    return over_texts(df, text, {name: T.DoubleType()}, work)


def gumbel_key(weight: Column, doc_id: Column, seed: int) -> Column:
    uniform = (F.pmod(F.xxhash64(F.lit(seed), doc_id), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return weight - F.log(-F.log(uniform))


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 4096, few: int = 10_000) -> float:
    """Exact, by ever finer histograms; the values of a last narrow range are collected, `few` at most."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    left = df
    while low < high:
        width = (high - low) / bins
        if not width > 0 or low + width <= low:
            break
        at = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        found = left.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for r in sorted(found.collect(), key=lambda r: -r["bin"]):
            if k <= r["n"]:
                low, high, n = r["low"], r["high"], r["n"]
                break
            k -= r["n"]
        left = df.where(F.col(column).between(F.lit(low), F.lit(high)))
        if n <= few:
            return sorted((r[0] for r in left.select(column).collect()), reverse=True)[k - 1]
    values = left.groupBy(column).count().orderBy(F.desc(column)).limit(few)
    for value, n in values.collect():
        if k <= n:
            return value
        k -= n
    raise AssertionError("more than `few` distinct values without a representable difference")


def resample(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1, lose: float = LOSE, **settings
) -> DataFrame:
    """`docs` with log_weight, gumbel_key and kept."""
    ratio, targets = fit(docs, labels, doc_id, text, **settings)
    weighed = weigh(docs, ratio, text).withColumn("gumbel_key", gumbel_key(F.col("log_weight"), F.col(doc_id), seed))
    keys = staged(weighed.select(F.col(doc_id).alias("_id"), "log_weight", "gumbel_key"), "importance")
    known = keys.join(F.broadcast(targets), "_id", "left_semi")
    n = known.count()
    if not n:
        return weighed.withColumn("kept", F.lit(True))
    cut = kth_largest(known, "log_weight", max(1, n - int(n * lose)))
    k = keys.where(F.col("log_weight") >= F.lit(cut)).count()
    least = kth_largest(keys, "gumbel_key", k)
    return weighed.withColumn("kept", F.col("gumbel_key") >= F.lit(least))


def keep_good(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The documents that the resampling keeps, with their own columns."""
    return filtered(docs, ["log_weight", "gumbel_key", "kept"], lambda df: resample(df, labels, **settings).where("kept"))
