"""CSV / Parquet readers and writers with the checks the jobs rely on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.schemas import REQUIRED_SALES, REQUIRED_STORE, SALES_COLUMNS, STORE_COLUMNS, require_columns, text_schema
from daybook.operators.cleaning import coerce_types

INGEST_SEQ = "ingest_seq"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path))


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote and nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _header(spark: SparkSession, path: str, what: str) -> list[str]:
    """Column names of a CSV file or folder: reads one line."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"{what}: no such file: {path}")
    try:
        columns = spark.read.option("header", True).csv(path).columns
    except AnalysisException as error:
        raise ValueError(f"{what}: the file is empty: {path}") from error
    if not columns:
        raise ValueError(f"{what}: the file is empty: {path}")
    return columns


def _scan_csv(spark: SparkSession, path: str, known: Sequence[str], required: Sequence[str], what: str) -> DataFrame:
    header = _header(spark, path, what)
    require_columns(header, required, what)
    # The schema follows the header's order; unknown columns are read as text and pruned by the projection.
    frame = spark.read.schema(text_schema(header)).option("header", True).option("enforceSchema", False).csv(path)
    return frame.select(*[c for c in known if c in header], *[c for c in frame.columns if c not in known], "_metadata")


def scan_sales(spark: SparkSession, path: str) -> DataFrame:
    """Sales CSV as text columns plus `ingest_seq`, the position of the row in the input.

    Within one file split the generated id grows with the row; file name and split offset order the splits.
    """
    raw = _scan_csv(spark, path, SALES_COLUMNS, REQUIRED_SALES, "sales")
    seq = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("row"),
    )
    return raw.withColumn(INGEST_SEQ, seq).drop("_metadata")


def scan_store(spark: SparkSession, path: str) -> DataFrame:
    """Store CSV, typed."""
    raw = _scan_csv(spark, path, STORE_COLUMNS, REQUIRED_STORE, "store").drop("_metadata")
    typed = coerce_types(raw, check_fractions=False)
    return typed.withColumn("Store", F.col("Store").cast("int"))


def scan_stage(spark: SparkSession, path: str, required: Sequence[str] = ("Sales",)) -> DataFrame:
    """A staged Parquet dataset; it must exist, have rows and the required columns."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"staged dataset not found: {path}")
    df = spark.read.parquet(path)
    require_columns(df.columns, required, "staged dataset")
    if df.isEmpty():
        raise ValueError(f"staged dataset is empty: {path}")
    return df


def sink_stage(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrites a staged dataset; CSV carries a header and ISO dates. Parallelism is that of the plan."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    else:
        writer.parquet(path)


def report_sink(df: DataFrame, path: str, fmt: str = "json") -> None:
    """A report of a few rows as one file; failed models go to CSV only."""
    rows = df.where(F.col("error").isNull()).drop("error") if fmt == "json" and "error" in df.columns else df
    writer = rows.coalesce(1).write.mode("overwrite")
    writer.json(path) if fmt == "json" else writer.option("header", True).csv(path)


INVENTORY_SCHEMA = "name string, path string, exists boolean, files bigint, size bigint, mtime timestamp"


def file_inventory(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Per dataset: exists, number of files, bytes, newest modification. Only file listings are read."""
    rows = None
    for name, path in paths.items():
        if path_exists(spark, path):
            listing = (
                spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
                .select("path", "length", "modificationTime")
            )
            row = listing.agg(
                F.lit(name).alias("name"),
                F.lit(path).alias("path"),
                F.lit(True).alias("exists"),
                F.count(F.lit(1)).alias("files"),
                F.coalesce(F.sum("length"), F.lit(0)).alias("size"),
                F.max("modificationTime").alias("mtime"),
            )
        else:
            row = spark.createDataFrame([(name, path, False, 0, 0, None)], INVENTORY_SCHEMA)
        rows = row if rows is None else rows.unionByName(row)
    if rows is None:
        raise ValueError("file_inventory: no datasets given")
    return rows


def set_modified(spark: SparkSession, path: str, at: datetime) -> None:
    """Gives all files of a dataset one modification time."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found, stamp = fs.listFiles(target, True), int(at.replace(tzinfo=timezone.utc).timestamp() * 1000)
    while found.hasNext():
        fs.setTimes(found.next().getPath(), stamp, -1)


def freshness(inventory: DataFrame, hours: float = 24.0, now: Column | None = None) -> DataFrame:
    """Datasets with their age at `now` (the clock by default); `fresh` when touched within the last hours."""
    now = F.current_timestamp() if now is None else now
    age = (now.cast("double") - F.col("mtime").cast("double")) / 3600
    return inventory.select("name", "exists", age.alias("age_hours"), F.coalesce(age < hours, F.lit(False)).alias("fresh"))


def freshness_gate(spark: SparkSession, path: str, hours: float = 24.0, now: Column | None = None) -> bool:
    return bool(freshness(file_inventory(spark, {"input": path}), hours, now).first()["fresh"])


def retrain_gate(spark: SparkSession, model_path: str, features_path: str) -> bool:
    """True without a model or without features, or when the features are newer than the model."""
    seen = {r["name"]: r for r in file_inventory(spark, {"model": model_path, "features": features_path}).collect()}
    model, features = seen["model"], seen["features"]
    if not model["exists"] or not features["exists"] or model["mtime"] is None or features["mtime"] is None:
        return True
    return features["mtime"] > model["mtime"]
