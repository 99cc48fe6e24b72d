"""op4_ring: every document in one of 16 shards."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.llm import ring
from daybook.llm.registry import query, table


@query("op4_ring")
def op4_ring(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
    )
    return ring.assign(rows, "doc_id", 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "home_shard",
    )
