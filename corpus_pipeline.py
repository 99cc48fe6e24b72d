"""From raw documents to tokens: selection, near copies, repeated passages, benchmark passages, byte-level BPE.

Each stage works on all that the one before it kept. Its result is written to the shared folder and read again, so a lost
executor costs one stage at most. All but the last return the columns of `documents`.

- quality: the importance resampling rejects documents; rejected ones go.
- near_copies: one document of each class of near copies stays, the one of smallest id.
- passages: every byte under a string of 400 bytes or under a passage of 51 words that occurs elsewhere goes, and with it a
  character cut in two; a document that loses all its text goes, one that had none stays. n_chars is that of the new text.
- benchmark: documents with ten consecutive words of a benchmark item go.
- tokens: doc_id, lang, source, n_tokens, ids and the text decoded from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import bpe, dart, decontaminate, quality, suffix
from daybook.llm.query_tokens import tokenizer_path
from daybook.llm.registry import filtered, in_passing, table

PASSAGE_WORDS = 51


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dart.keep_first(docs)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def work(df: DataFrame) -> DataFrame:
        left = suffix.remove_repeats(df, as_text=True, words=PASSAGE_WORDS).where("n_bytes = 0 or kept_text <> ''")
        left = left.withColumn("text", F.when(F.size("removed") > 0, F.col("kept_text")).otherwise(F.col("text")))
        return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))

    return filtered(docs, ["n_bytes", "removed", "kept", "kept_text", "_key", "_copies", "_spans", "_codes", "_word_key", "_word_copies", "_word_spans"], work)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    made = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), tokenizer_path())
    return made.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("quality", select_quality),
    ("near_copies", drop_near_copies),
    ("passages", drop_passages),
    ("benchmark", drop_benchmark),
    ("tokens", tokenize),
]

ORACLE_SQL = None  # the resampling draws from fitted models


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = in_passing(lambda: stage(spark, docs, sf_dir), name)  # noqa: B023
    return docs
