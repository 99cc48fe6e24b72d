"""Row and null counts of a job's steps, taken by the pass that writes its result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ROWS = "rows"


class Steps:
    """Marks places in a plan; after an action that ran through them their counts are there, without another pass.

    `at` hands the frame on with its rows counted, and nulls of `nulls`. Ask for `removed` or `nulls` after the result is written:
    they wait for it. One `Steps` serves one action.
    """

    def __init__(self) -> None:
        self._seen: list[tuple[str, Observation, list[str]]] = []

    def at(self, step: str, df: DataFrame, nulls: Sequence[str] = ()) -> DataFrame:
        if any(step == name for name, _, _ in self._seen):
            raise ValueError(f"step {step} is counted already")
        seen = Observation(f"{step}-{id(self)}")
        self._seen.append((step, seen, list(nulls)))
        counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null {c}") for c in nulls]
        return df.observe(seen, F.count(F.lit(1)).alias(ROWS), *counts)

    def removed(self, spark: SparkSession) -> DataFrame:
        """step, rows, removed (since the step before), in order."""
        rows, before = [], None
        for number, (step, seen, _) in enumerate(self._seen):
            n = seen.get[ROWS]
            rows.append((number, step, n, 0 if before is None else before - n))
            before = n
        return spark.createDataFrame(rows, "number int, step string, rows long, removed long")

    def nulls(self, spark: SparkSession) -> DataFrame:
        """step, column, nulls."""
        rows = [(step, c, seen.get[f"null {c}"]) for step, seen, columns in self._seen for c in columns]
        return spark.createDataFrame(rows, "step string, column string, nulls long")
