"""op6_bpe: ids and round trip of every document."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.llm import bpe
from daybook.llm.registry import query, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op6_bpe")
def op6_bpe(spark, sf_dir):
    tokens = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
