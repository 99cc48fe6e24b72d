"""Session helpers: a local builder for tests and benches, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "daybook", memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", own_scratch())
        .getOrCreate()
    )


def own_scratch() -> str:
    """A folder for one local process, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="daybook-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_root(spark: SparkSession) -> str:
    """The folder that the cluster shares. Only a local master without one gets a folder of its own."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    if not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(own_scratch())
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


# Nodes that make a second evaluation of a plan dearer than reading its result back.
_COSTLY = ("Aggregate", "Join", "Window", "Generate", "Sort", "InPandas")


def materialize(df: DataFrame, name: str = "rows") -> DataFrame:
    """`df` for an operator that passes over it more than once.

    A plain scan with filters and projections is returned as it is. Anything with a shuffle in it is written
    once to the shared scratch folder and read back, so the passes do not repeat it and a lost executor only
    costs a re-read. Callers project to the few columns they need first.
    """
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if not any(node in plan for node in _COSTLY):
        return df
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
