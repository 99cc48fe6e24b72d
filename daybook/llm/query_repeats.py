"""op7_repeats: what is left of every document without passages of 400 bytes that occur elsewhere."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.llm import suffix
from daybook.llm.registry import query, table


@query("op7_repeats")
def op7_repeats(spark, sf_dir):
    left = suffix.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), as_text=True)
    return left.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        "kept_text",
    )
