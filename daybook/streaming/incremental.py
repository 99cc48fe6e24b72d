"""New daily files to the sales history: exactly-once file tracking, idempotent upserts, late rows welcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from daybook.plans.jobs import clean_job
from daybook.sources.tables import Warehouse


ARRIVAL = ("__time", "__file", "__offset")


def landing_files(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "csv", files_per_batch: int = 1000
) -> DataFrame:
    """Stream of landing-folder rows with the file facts that order them."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if fmt == "csv":
        reader = reader.option("header", True)
    facts = ("file_modification_time", "file_path", "file_block_start")
    return reader.format(fmt).load(path).select("*", *[F.col(f"_metadata.{f}").alias(n) for f, n in zip(facts, ARRIVAL)])


def incremental_history(
    source: DataFrame, warehouse: Warehouse, checkpoint: str, order_by: Sequence[str] = (), once: bool = True
) -> StreamingQuery:
    """Starts the stream. Each micro-batch is cleaned and upserted; a replayed batch gives the same table.

    De-duplication inside a batch keeps the last row by `order_by` (default: newest file, then position);
    between batches the later batch wins.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        keys = list(order_by)
        if not keys:
            # Row ids are not allowed in a streaming plan but fine on the batch.
            batch = batch.withColumn("ingest_seq", F.struct(*ARRIVAL, F.monotonically_increasing_id().alias("row")))
            batch, keys = batch.drop(*ARRIVAL), ["ingest_seq"]
        warehouse.recover()
        warehouse.upsert_history(clean_job(batch, keys))

    writer = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()
