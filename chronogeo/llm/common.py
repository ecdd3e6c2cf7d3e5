"""Helpers shared by the operators of this subpackage: Arrow maps, shared folders, checked broadcasts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import cut, shared_dir

__all__ = ["arrow_map", "cut", "i64", "shared_dir", "signed", "small", "table", "tidied", "tidy"]

#: rows-times-width bound, in bytes, under which a side of a join may be broadcast
BROADCAST_BYTES = 48 << 20
#: id that stands for a null doc_id while documents are ranked: nulls rank last
NULL_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(df: DataFrame, rows: int, width: int) -> DataFrame:
    """df, marked for broadcast if rows * width bytes stay below BROADCAST_BYTES; a plain shuffle join otherwise."""
    return F.broadcast(df) if rows * width <= BROADCAST_BYTES else df


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from fn(b)
        tidy()

    return df.mapInArrow(run, schema)


def tidy() -> None:
    """Gives freed memory back to the system: Python workers are used again, and keep what their largest task took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidied(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """fn, for mapInArrow, with tidy() at the end of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        tidy()

    return run


def i64(x) -> pa.Array:
    return pa.array(np.asarray(x).astype(np.int64, copy=False), pa.int64())


def signed(x: np.ndarray) -> pa.Array:
    """uint64 as a bigint column."""
    return pa.array(x.view(np.int64), pa.int64())
