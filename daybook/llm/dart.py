"""Near copies by DartMinHash: weighted signatures from hashed darts, banded joins, exact similarity, classes.

The elements of a text are its shingles of `words` words (lower case; a shorter text is one shingle), weighted by how
often they occur. Darts fall on the plane of weight and rank: each (element, unit of weight, cell of rank) has a Poisson
number of them, with places and a coordinate of the signature drawn from the hash of the cell. Only darts inside a text's
weighted regions count, and the lowest rank per coordinate is kept. Ranks are thrown in rising cells until every
coordinate has a dart, so a long text, which needs low ranks only, costs little more than one look per element. Two texts
agree on a coordinate with the probability of their weighted Jaccard similarity.

Signatures are cut into bands. Equal texts are joined first, by digest. Texts that share a band form a bucket; a
bucket links its members to a centre (the member that meets most others over all bands) instead of to each other, and
each link is checked on the whole weighted sets. The links' connected components, by smallest label with pointer
jumping, are the classes so far. Only members of different classes are ever compared, no pair twice, and a bucket whose
members are of one class is done. Members of bands that are left with more classes meet again, in buckets of their rarest
units (`prefix_buckets`): any pair of them at `least` or more shares one, while a family of texts that share bands but are
less similar than that hardly does, so its members are not compared with all others. These buckets have centres too: each
round eight times as many, taken from the smallest classes, and those that have met all of a bucket leave it. Rounds
end when no bucket has members of two classes that have not met, so no class is split by the choice of a centre.

With 64 bands of 8, a pair at similarity 0.8 shares no band once in 130,000; more similar pairs far less often. Null and
empty texts, or texts without a word, are near copies of texts equal to them only (null counts as empty). All tables between steps
are written to the shared folder. Buckets are joined with sort-merge joins that Spark splits where they are skewed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.arrowmap import lists, over_texts
from daybook.llm.byteops import flat, gram_hashes, lower, mix, word_hashes, words
from daybook.llm.decontaminate import WORD
from daybook.llm.registry import filtered, staged

WORDS = 5
LEAST = 0.8
BANDS = 64
ROWS = 8
CENTRES = 16  # of a bucket in the first round by rarest units; each later round has as many times more

_SIZE_CLASS = 1.05  # sizes of a class differ by less than this factor
_SLACK = 1e-6  # of places and sizes, so that no tie at the least similarity is lost to rounding
_DARTS = 1 << 18  # cells that are looked at together
_SLICE = 1 << 18  # bytes of text that are
_FIRST_CELL = 8  # the lowest cell of ranks is [0, 2 ** -8); each next one doubles the end
_STEP = np.uint64(0xA0761D6478BD642F)


def elements(column: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed units of weight of all texts, and the row of each: the s-th occurrence of a shingle is its s-th unit."""
    raw, bounds = flat(column)
    raw = lower(raw)
    starts, ends, by_text = words(raw, bounds, WORD)
    hashes = word_hashes(raw, starts, ends)
    counts = np.diff(by_text)
    width = np.minimum(counts, size)
    n = np.where(counts > 0, counts - width + 1, 0)
    row = np.repeat(np.arange(len(counts)), n)
    first = by_text[:-1][row] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    grams = np.zeros(len(first), np.uint64)
    for w in np.unique(width[width > 0]):
        some = width[row] == w
        grams[some] = gram_hashes(hashes, first[some], int(w)) + np.uint64(w)
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    at = np.arange(len(grams))
    unit = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return mix(grams + unit.astype(np.uint64) * _STEP), row


def _poisson(mean: float) -> np.ndarray:
    terms = [math.exp(-mean)]
    while terms[-1] > 1e-18 or len(terms) <= mean:
        terms.append(terms[-1] * mean / len(terms))
    return np.cumsum(terms)


def signatures(units: np.ndarray, row: np.ndarray, n: int, k: int, part: np.ndarray | None = None) -> np.ndarray:
    """n x k: the rank and name of the first dart of each coordinate. A row without units keeps the largest value.

    part: how much of each unit of weight belongs to the element (all of it by default).
    """
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    found = np.full(n * k, empty, np.uint64)
    weight = np.bincount(row, minlength=n)
    enough = k * (math.log(k) + 3)  # darts that leave a coordinate without one in a row of twenty
    level = np.zeros(n, np.int64)
    some = weight > 0
    level[some] = np.maximum(0, np.ceil(np.log2(enough / weight[some])) + _FIRST_CELL)
    open_, cell = some.copy(), 0
    while open_.any():
        low = 0.0 if cell == 0 else 2.0 ** (cell - 1 - _FIRST_CELL)
        width = 2.0**-_FIRST_CELL if cell == 0 else low
        pieces = max(1, int(width))
        width /= pieces
        inside = np.flatnonzero(open_[row])
        cdf = _poisson(width)
        for lo in range(0, len(inside), max(1, _DARTS // pieces)):
            who = np.repeat(inside[lo : lo + max(1, _DARTS // pieces)], pieces)
            piece = np.tile(np.arange(pieces), len(who) // pieces)
            name = mix(units[who] ^ mix((np.uint64(cell) << np.uint64(32)) + piece.astype(np.uint64) + np.uint64(1)))
            darts = np.searchsorted(cdf, (name >> np.uint64(11)).astype(np.float64) * 2.0**-53, side="right")
            hit = np.flatnonzero(darts)
            times = darts[hit]
            at = np.repeat(hit, times)
            index = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            dart = mix(name[at] + (index.astype(np.uint64) + np.uint64(1)) * _STEP)
            if part is not None:
                height = (mix(dart ^ _STEP) >> np.uint64(11)).astype(np.float64) * 2.0**-53
                some_ = height <= part[who[at]]
                at, dart = at[some_], dart[some_]
            rank = low + (piece[at] + (dart >> np.uint64(32)).astype(np.float64) * 2.0**-32) * width
            coordinate = ((dart & np.uint64(0xFFFFFFFF)) * np.uint64(k)) >> np.uint64(32)
            value = (rank.view(np.uint64) & np.uint64(0xFFFFFFFFFF000000)) | (mix(dart) >> np.uint64(40))
            np.minimum.at(found, row[who[at]] * k + coordinate.astype(np.int64), value)
        cell += 1
        due = open_ & (cell > level)
        if due.any():
            rows = np.flatnonzero(due)
            open_[rows[(found.reshape(n, k)[rows] != empty).all(axis=1)]] = False
    return found.reshape(n, k)


def band_hashes(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    n = len(found)
    parts = found[:, : bands * rows].reshape(n, bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, (n, bands)).copy()
    for j in range(rows):
        out = mix(out * np.uint64(0xE7037ED1A0B428DB) + parts[:, :, j])
    return out


def with_bands(df: DataFrame, text: str = "text", words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """`df` with `bands`: the hashes of the bands of each text, none for a text without a word."""

    def work(column: pa.Array) -> dict[str, pa.Array]:
        units, row = elements(column, words)
        hashes = band_hashes(signatures(units, row, len(column), bands * rows), bands, rows)
        some = np.bincount(row, minlength=len(column)) > 0
        return {"bands": lists(hashes[some].ravel().view(np.int64), some * bands)}

    return over_texts(df, text, {"bands": T.ArrayType(T.LongType())}, work, _SLICE)


def with_units(df: DataFrame, text: str = "text", words: int = WORDS) -> DataFrame:
    """`df` with `units`: the weighted set of each text."""

    def work(column: pa.Array) -> dict[str, pa.Array]:
        units, row = elements(column, words)
        return {"units": lists(units.view(np.int64), np.bincount(row, minlength=len(column)))}

    return over_texts(df, text, {"units": T.ArrayType(T.LongType())}, work, _SLICE)


def prefix_buckets(sets: DataFrame, least: float) -> DataFrame:
    """(bucket, key, owner): two weighted sets whose similarity is `least` or more share a bucket that one of them owns.

    The units of a set are ordered by how many of these sets have them, rarest first. The first common unit of a similar pair
    stands so early in both that what follows can still hold the common part that their sizes ask for. The smaller set owns
    the buckets (unit, its size class); the larger one visits those of each size that such a place allows. Sets that have much
    in common, yet less than `least`, differ in units that few have, so their early units are not the common ones.
    """
    step = math.log(_SIZE_CLASS)
    class_of = lambda size: F.floor(F.log(F.greatest(size, F.lit(1.0))) / step).cast("int")
    units = staged(sets.select("key", F.size("units").alias("size"), F.explode("units").alias("unit")), "units")
    held = units.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # The last place that a first common unit can have; what stands behind it meets nobody.
    last = F.floor(F.col("size") * (1 - least) + _SLACK).cast("int")
    order = F.array_sort(F.collect_list(F.struct("n", "unit")))
    ranked = units.join(held, "unit", "left").select("key", "size", F.coalesce("n", F.lit(1)).alias("n"), "unit")
    early = ranked.groupBy("key", "size").agg(order.alias("_all")).select("key", "size", F.slice("_all", F.lit(1), last + 1).alias("_early"))
    placed = early.select("key", "size", F.posexplode("_early").alias("at", "_u")).where("_u.n > 1")
    rest = F.col("size") - F.col("at") + _SLACK
    most = F.least(F.col("size").cast("double"), rest * (1 + least) / least - F.col("size"))
    placed = placed.select(
        "key", F.col("_u.unit").alias("unit"), class_of(F.col("size").cast("double")).alias("own"),
        (rest >= F.col("size") * (2 * least / (1 + least))).alias("small"),
        class_of(F.col("size") * least - _SLACK).alias("low"), class_of(most + _SLACK).alias("high"),
    )
    placed = placed.where("low <= high").withColumn("class", F.explode(F.sequence("low", "high")))
    return placed.select(F.xxhash64("unit", "class").alias("bucket"), "key", (F.col("small") & (F.col("class") == F.col("own"))).alias("owner"))


def _mixed(active: DataFrame, labels: DataFrame | None) -> DataFrame:
    """`active` with labels and n, the size of the bucket; only of buckets with an owner and members of two classes."""
    if labels is None:
        active = active.withColumn("label", F.col("key"))
    else:
        active = active.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    facts = active.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high"), F.max("owner").alias("owned")
    )
    return active.join(facts.where("low <> high and owned").select("bucket", "n"), "bucket")


def _links(members: DataFrame, sets: DataFrame, least: float) -> tuple[DataFrame | None, DataFrame | None]:
    """Links (a, b, similarity) that join all similar members (bucket, key) into classes, and their components (key, label)."""
    links, labels, judged, centres_each = None, None, None, 1
    active, by_bands = members.withColumn("owner", F.lit(True)), True
    while True:
        active = _mixed(active, labels)
        degree = active.groupBy("key").agg(F.sum("n").alias("degree"))
        active = active.select("bucket", "key", "owner", "label").join(degree, "key")
        # After the first round small classes come first: their few members meet all of a large class at once.
        own = active.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("own"))
        active = active.withColumn("own", F.lit(0)) if labels is None else active.join(own, ["bucket", "label"])
        active = staged(active, "members")
        if active.isEmpty():
            return links, labels
        first = Window.partitionBy("bucket").orderBy("own", F.desc("degree"), F.desc("key"))
        centres = active.where("owner").withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= centres_each)
        centres = centres.select("bucket", F.col("key").alias("centre"), F.col("label").alias("other"))
        placed = active.join(centres, "bucket").where("label <> other")
        pairs = placed.select(F.least("key", "centre").alias("a"), F.greatest("key", "centre").alias("b")).distinct()
        if judged is not None:  # members that met in another bucket need not be compared again
            pairs = pairs.join(judged, ["a", "b"], "left_anti")
        pairs = pairs.join(sets.select(F.col("key").alias("a"), F.col("units").alias("_a")), "a")
        pairs = pairs.join(sets.select(F.col("key").alias("b"), F.col("units").alias("_b")), "b")
        both = F.size(F.array_intersect("_a", "_b"))
        pairs = staged(pairs.select("a", "b", (both / (F.size("_a") + F.size("_b") - both)).alias("similarity")), "pairs")
        judged = pairs if judged is None else judged.unionByName(pairs)
        found = pairs.where(F.col("similarity") >= least)
        if labels is None or not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            labels = extended(labels, found)
        # Centres have met all of their bucket that is not of their class.
        active = active.join(centres.select("bucket", F.col("centre").alias("key")), ["bucket", "key"], "left_anti")
        active = active.select("bucket", "key", "owner")
        if by_bands:  # members of bands that the centres have not told apart meet by their rarest units from now on
            apart = _mixed(active, labels).select("key").distinct()
            active, by_bands = staged(prefix_buckets(sets.join(apart, "key", "left_semi"), least), "prefixes"), False
            centres_each = CENTRES
        else:
            centres_each *= CENTRES


def extended(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components `labels` after more `links`: only the labels that these link are worked on."""
    if labels is None:
        return components(links)
    ends = links.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    own = ends.join(labels, "key", "left_anti").select("key", F.col("key").alias("label"))
    labels = staged(labels.unionByName(own), "labels")
    between = links.select("a", "b")
    for end in ("a", "b"):
        between = between.join(labels.select(F.col("key").alias(end), F.col("label").alias(f"_{end}")), end)
    between = between.select(F.col("_a").alias("a"), F.col("_b").alias("b")).where("a <> b")
    joined = components(between).select(F.col("key").alias("label"), F.col("label").alias("_label"))
    return staged(labels.join(joined, "label", "left").select("key", F.coalesce("_label", "label").alias("label")), "labels")


def components(links: DataFrame) -> DataFrame:
    """(key, label): the smallest key of each connected component, for the keys in links (a, b)."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = staged(both, "edges")
    labels = staged(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "key"), "labels")
    while True:
        near = both.join(labels.select(F.col("key").alias("b"), F.col("label").alias("other")), "b")
        near = near.groupBy(F.col("a").alias("key")).agg(F.min("other").alias("other"))
        best = labels.join(near, "key").select("key", F.col("label").alias("old"), F.least("label", "other").alias("label"))
        best = staged(best, "labels")
        above = best.select(F.col("key").alias("label"), F.col("label").alias("above"))
        jumped = best.join(above, "label", "left").select("key", "old", F.least("label", F.coalesce("above", "label")).alias("label"))
        jumped = staged(jumped, "labels")
        labels = jumped.select("key", "label")
        if jumped.where("label <> old").isEmpty():
            return labels


def classes(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, least: float = LEAST,
    bands: int = BANDS, rows: int = ROWS,
) -> tuple[DataFrame, DataFrame]:
    """One row per row of `df`: doc_id, key (digest of the text), class_id (smallest doc_id of its class), class_key.

    The second table has the links that make the classes: the digests a and b of different texts, and their similarity.
    """
    docs = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    digest = F.unhex(F.md5("text"))
    rows_ = staged(with_bands(docs.withColumn("key", digest), "text", words, bands, rows).drop("text"), "bands")
    texts = staged(rows_.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.any_value("bands").alias("bands")), "texts")
    members = texts.select("key", F.explode("bands").alias("bucket"))
    crowded = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = staged(members.join(crowded, "bucket"), "members")
    wanted = texts.join(members.select("key").distinct(), "key", "left_semi").select("key", "first_id")
    # One document of each wanted text, found by its id so that copies do not meet in one task.
    whole = docs.withColumn("key", digest).join(
        wanted.select(F.col("key").alias("_key"), "first_id"), (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    )
    whole = with_units(whole.select("key", "text"), "text", words).select("key", "units")
    sets = staged(whole.groupBy("key").agg(F.any_value("units").alias("units")), "sets")
    links, labels = _links(members, sets, least)
    if links is None:
        links = df.sparkSession.createDataFrame([], "a binary, b binary, similarity double")
        labels = links.select(F.col("a").alias("key"), F.col("b").alias("label"))
    labelled = texts.select("key", "first_id").join(labels, "key", "left")
    labelled = staged(labelled.select("key", "first_id", F.coalesce("label", "key").alias("class_key")), "classes")
    firsts = labelled.groupBy("class_key").agg(F.min("first_id").alias("class_id"))
    by_text = labelled.join(firsts, "class_key").select("key", "class_key", "class_id")
    return rows_.select("doc_id", "key").join(by_text, "key"), links


def keep_first(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row of each class: of its smallest doc_id (a null id counts only if there is no other), else of the smallest digest."""
    found, _ = classes(df, doc_id, text, **settings)
    first = found.groupBy("class_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"))
    first = first.select(F.col("first.doc_id").alias("_id"), F.col("first.key").alias("_key"))

    def keep(rows: DataFrame) -> DataFrame:
        marked = rows.withColumn("_digest", F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))))
        kept = marked.join(first, (F.col("_digest") == F.col("_key")) & F.col(doc_id).eqNullSafe(F.col("_id")))
        return kept.dropDuplicates(["_digest"])

    return filtered(df, ["_digest", "_id", "_key"], keep)
