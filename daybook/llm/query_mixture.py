"""op11_mixture: all documents, mixed by source to weights of 5, 2 and 1."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.llm import mixture
from daybook.llm.registry import query, staged, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all sizes
MOST = 2.0  # of a source's size


@query("op11_mixture")
def op11_mixture(spark, sf_dir):
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", words.alias("size"), F.xxhash64("text").alias("digest"))
    docs = staged(docs, "words")
    sizes = docs.groupBy("source").agg(F.sum("size").alias("size"))
    targets = staged(mixture.weighed_targets(sizes, WEIGHTS, SHARE, MOST), "targets")
    # A null source is a source too: names are marked so that it can't be mistaken for a text.
    name = F.when(F.col("source").isNull(), "none").otherwise(F.concat(F.lit("source "), F.col("source")))
    quotas = targets.select(name.alias("source"), F.round("target").cast("long").alias("quota"))
    mixed = mixture.mix(docs, F.array(name), F.col("size"), quotas, ["doc_id", "digest"])
    facts = targets.select(F.col("source").alias("_source"), F.col("size").alias("source_size"), "target")
    return mixed.join(facts, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "size", "source_size", "target", "taken")
