"""Registry of this subpackage's queries, and how they read a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.session import scratch_path
from daybook.sources.files import remove_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_ROWS = 1000
_PASSING: list[list[str]] = []  # folders of the tables staged by each `in_passing` that is at work


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back: later passes repeat nothing, a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    if _PASSING:
        _PASSING[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_passing(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What `make` returns, staged; the tables that were staged on the way to it are removed then.

    Rows go to Python `_BATCH_ROWS` at a time meanwhile, as whole texts make large batches.
    """
    conf = SparkSession.active().conf
    before = conf.get(_BATCHES)
    conf.set(_BATCHES, str(min(int(before), _BATCH_ROWS)))
    _PASSING.append([])
    try:
        made = make()
        path = scratch_path(made.sparkSession, name)
        made.write.parquet(path)
    finally:
        inner = _PASSING.pop()
        conf.set(_BATCHES, before)
    for done in inner:
        remove_path(made.sparkSession, done)
    if _PASSING:
        _PASSING[-1].append(path)
    return made.sparkSession.read.schema(made.schema).parquet(path)


def filtered(df: DataFrame, made: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`work(df)` with the columns of `df` only: own columns that are called like those in `made` are put aside meanwhile."""
    aside = {c: f"own {k} {c}" for k, c in enumerate(df.columns) if c in made}
    out = work(df.withColumnsRenamed(aside))
    return out.select([out[f"`{aside[c]}`"].alias(c) if c in aside else out[f"`{c}`"] for c in df.columns])
