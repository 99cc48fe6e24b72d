"""Rows that fail a check leave by a second output of the same pass, with the reason and the place they came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.cleaning import to_number

REJECTED, REASON = "rejected", "reason"


def reject_reason(date_format: str = "yyyy-MM-dd") -> Column:
    """The first check that a raw sales row fails, null if it passes all."""
    return (
        F.when(to_number(F.col("Store")).isNull(), "store is no number")
        .when(F.try_to_date("Date", date_format).isNull(), "date is no date")
        .when(to_number(F.col("Sales")).isNull(), "sales is no number")
    )


def split_rejects(raw: DataFrame, path: str, reason: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) rows of `raw`, written in one pass to two folders under `path` and read back.

    Rejected rows carry `reason`; the columns of `raw`, its `ingest_seq` (file, offset, row) among them, say where they are from.
    """
    judged = raw.withColumn(REASON, reason if reason is not None else reject_reason()).withColumn(REJECTED, F.col(REASON).isNotNull())
    judged.write.partitionBy(REJECTED).parquet(path)
    schema = judged.schema
    stored = raw.sparkSession.read.schema(schema).parquet(path)
    return stored.where(~F.col(REJECTED)).drop(REASON, REJECTED), stored.where(F.col(REJECTED)).drop(REJECTED)


def reject_counts(spark: SparkSession, path: str) -> DataFrame:
    """reason ('' for kept rows) and rows of a folder written by `split_rejects`."""
    stored = spark.read.parquet(path)
    return stored.groupBy(F.coalesce(REASON, F.lit("")).alias(REASON)).agg(F.count(F.lit(1)).alias("rows"))
