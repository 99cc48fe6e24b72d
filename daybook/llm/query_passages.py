"""op3_passages: benchmark windows in every document."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.llm import decontaminate
from daybook.llm.registry import query, table


@query("op3_passages")
def op3_passages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.col("longest").alias("longest_match"),
        F.size("matches").cast("long").alias("n_matches"),
    )
