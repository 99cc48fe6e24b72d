"""A function over a text column's Arrow batches, with the other columns passed through."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from daybook.llm.byteops import SLICE_BYTES, flat, slices


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + list(columns.values()), names=kept + list(columns))


def release() -> None:
    """Gives memory back that Arrow and the C library keep for later: a Python worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def over_texts(
    df: DataFrame, column: str, more: dict[str, T.DataType], work: Callable[[pa.Array], dict[str, pa.Array]], most: int = SLICE_BYTES
) -> DataFrame:
    """`df` with the columns that `work` makes from slices of about `most` bytes of text; a column of the same name is replaced."""
    schema = T.StructType([f for f in df.schema.fields if f.name not in more] + [T.StructField(n, t) for n, t in more.items()])

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            at = batch.column(batch.schema.get_field_index(column))
            kind = at.type
            texts = any(is_(kind) for is_ in (pa.types.is_string, pa.types.is_large_string, pa.types.is_binary, pa.types.is_large_binary))
            for lo, hi in slices(flat(at)[1] if texts else np.arange(len(at) + 1) * 4096, most):
                yield with_columns(batch.slice(lo, hi - lo), work(at.slice(lo, hi - lo)))
        release()

    return df.mapInArrow(batches, schema)


def lists(values: pa.Array | np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of `values` as lists, counts[i] of them in list i."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values if isinstance(values, pa.Array) else pa.array(values))
