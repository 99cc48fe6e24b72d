"""Order MinHash fingerprints: likeness in edit distance, not only in content.

A text's k-mers are runs of two words (pieces between single spaces); a repeated k-mer is told apart by the number of its
occurrence. Each numbered k-mer falls into one of `bins` bins by its hash; each bin selects its two minimal ones, puts them
back into text order and hashes that tuple. So an entry changes when its k-mers change or change places. This is the
method's signature with one permutation cut into bins instead of one permutation per entry: every k-mer is hashed once.
A text shorter than a k-mer is one k-mer; null and empty texts have none, and an empty fingerprint.

Only built-in functions are used. Texts are dealt by id once; numbering and selection are windows within a text, which
need no further exchange, and k-mers never leave their task. Rows that repeat an id and a text are worked out once
and given back as often; rows of one id with different texts are fingerprinted each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.registry import staged
from daybook.llm.ring import inline_table

BINS = 64
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
_HASH_BITS = 26  # of an entry; the bin stands above them


def fingerprints(df: DataFrame, keys: list[str], text: str, name: str, bins: int = BINS) -> DataFrame:
    """keys and `name`: the entries of the non-empty bins in order. keys tell rows apart; the first one is how `df` is dealt."""
    words = df.where(F.length(text) > 0).select(*keys, F.split(text, " ").alias("_w"))
    spots = words.select(*keys, "_w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("_w") - 2, F.lit(0)))).alias("_i"))
    kmers = spots.select(*keys, "_i", F.xxhash64(F.get("_w", F.col("_i")), F.get("_w", F.col("_i") + 1)).alias("_g"))
    occurrence = F.row_number().over(Window.partitionBy("_g", *keys).orderBy("_i"))
    numbered = kmers.withColumn("_h", F.xxhash64("_g", occurrence)).drop("_g")
    numbered = numbered.withColumn("_bin", F.pmod(F.col("_h"), F.lit(bins)).cast("int"))
    # A digest of the bin's keys comes first, as the first sort column is the one that Spark compares by prefix.
    numbered = numbered.withColumn("_k", F.xxhash64(*keys, "_bin"))
    chosen = numbered.withColumn("_r", F.row_number().over(Window.partitionBy("_k", *keys, "_bin").orderBy("_h", "_i"))).where("_r <= 2")
    # Place and hash in one long, so that the first and the last in the text are a minimum and a maximum.
    packed = F.shiftleft(F.col("_i").cast("long"), 32).bitwiseOR(F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF)))
    tuples = chosen.groupBy(*keys, "_bin").agg(F.min(packed).alias("_a"), F.max(packed).alias("_b"))
    low = F.lit(0xFFFFFFFF)
    hashed = F.xxhash64(F.col("_a").bitwiseAND(low), F.col("_b").bitwiseAND(low))
    entry = F.shiftleft("_bin", _HASH_BITS).bitwiseOR(F.shiftrightunsigned(hashed, 64 - _HASH_BITS).cast("int"))
    return tuples.select(*keys, entry.alias("_e")).groupBy(*keys).agg(F.array_sort(F.collect_list("_e")).alias(name))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries among the bins that either has; 1 for two empty fingerprints."""
    held = lambda x: F.transform(x, lambda e: F.shiftrightunsigned(e, _HASH_BITS))
    total = F.size(F.array_union(held(a), held(b)))
    return F.when(total == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / total)


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda e: F.lpad(F.lower(F.hex(e.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def successors(df: DataFrame, key: str, value: str, parts: int) -> DataFrame:
    """(key, next_key, previous, value): each distinct key with its neighbours in ascending order, in a ring.

    `value` is the largest of a key's rows. Keys are ordered within ranges between approximate quantiles; the ends of the
    ranges, `parts` at most, are tied together on the driver.
    """
    distinct = staged(df.groupBy(key).agg(F.max(value).alias(value)), "keys")
    shares = [i / parts for i in range(1, parts)]
    bounds = sorted(set(distinct.agg(F.percentile_approx(key, shares, 10_000)).first()[0] or [])) if shares else []
    part = F.size(F.filter(F.lit(bounds), lambda b: b < F.col(key))) if bounds else F.lit(0)
    ordered = distinct.withColumn("_part", part)
    ends = {r["_part"]: (r["low"], r["high"]) for r in ordered.groupBy("_part").agg(F.min(key).alias("low"), F.max(key).alias("high")).collect()}
    ring = sorted(ends)
    after = inline_table(
        df, [(p, ends[ring[(i + 1) % len(ring)]][0], ends[ring[i - 1]][1]) for i, p in enumerate(ring)], ["_part", "_next", "_before"]
    )
    within = Window.partitionBy("_part").orderBy(key)
    return ordered.join(F.broadcast(after), "_part").select(
        key, value,
        F.coalesce(F.lead(key).over(within), "_next").alias("next_key"),
        F.coalesce(F.lag(key).over(within), "_before").alias("previous"),
    )


def with_edits(df: DataFrame, bins: int = BINS, task_chars: int = 6_000_000) -> DataFrame:
    """Fingerprints of the texts of (doc_id, text) and of each text with its second half taken from the next document.

    doc_id, text digest, n_chars, edited_sha256, own, edited (fingerprints), next_key, and copies (equal rows). Rows without an
    id come before all others. The next document of several with one id is that of the smallest text.
    """
    docs = df.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    lengths = staged(docs.select("_id", F.length("text").cast("long").alias("n")), "lengths")
    rows, chars = lengths.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    tasks = max(1, math.ceil(chars / task_chars))
    chain = staged(successors(lengths, "_id", "n", max(1, min(1000, rows // 2048))), "chain")
    own = docs.repartition(tasks, "_id").groupBy("_id", "text").agg(F.count(F.lit(1)).alias("copies"))
    # What the previous document needs of this one: as many first characters as half its own.
    need = chain.join(chain.select(F.col("_id").alias("previous"), F.col("n").alias("_n")), "previous")
    need = need.select("_id", "previous", F.floor(F.col("_n") / 2).cast("int").alias("_half")).repartition(tasks, "_id")
    heads = own.groupBy("_id").agg(F.min("text").alias("text")).join(need, "_id")
    heads = heads.select(F.col("previous").alias("_id"), F.expr("substring(text, 1, _half)").alias("_head")).repartition(tasks, "_id")
    both = own.join(heads, "_id").join(chain.select("_id", "next_key").repartition(tasks, "_id"), "_id")
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    both = both.withColumns({"_n": n, "_half": half, "_digest": F.xxhash64("text")})
    edited = F.concat(F.expr("substring(text, 1, _n - _half)"), F.expr("substring(_head, 1, _half)"))
    both = both.select("_id", "_digest", "text", "copies", "next_key", F.col("_n").cast("long").alias("n_chars"), edited.alias("_edited"))
    versions = both.select("_id", "_digest", "copies", "next_key", "n_chars", F.sha2("_edited", 256).alias("_sha"),
                           F.posexplode(F.array("text", "_edited")).alias("_v", "_t"))
    made = fingerprints(versions, ["_id", "_digest", "_v"], "_t", "_f", bins)
    made = made.groupBy("_id", "_digest").agg(
        F.any_value(F.when(F.col("_v") == 0, F.col("_f")), ignoreNulls=True).alias("own"),
        F.any_value(F.when(F.col("_v") == 1, F.col("_f")), ignoreNulls=True).alias("edited"),
    )
    facts = both.select("_id", "_digest", "copies", "next_key", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"))
    none = F.array().cast("array<int>")
    out = facts.join(made, ["_id", "_digest"], "left").withColumns({c: F.coalesce(c, none) for c in ("own", "edited")})
    # Both sides are dealt by id already, which puts rows of one id and digest together: no exchange by both.
    conf = df.sparkSession.conf
    before = conf.get(_ALL_KEYS)
    conf.set(_ALL_KEYS, "false")
    try:
        return staged(out, "fingerprints")
    finally:
        conf.set(_ALL_KEYS, before)


def compare_edits(df: DataFrame, bins: int = BINS) -> DataFrame:
    """One row per row of `df`: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    made = with_edits(df, bins)
    following = made.groupBy("_id").agg(F.min_by("own", "_digest").alias("_next")).withColumnRenamed("_id", "next_key")
    out = made.join(following, "next_key").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(
        F.when(F.col("_id") != F.lit(-(1 << 63)), F.col("_id")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("_next")).alias("near_next"),
    )
