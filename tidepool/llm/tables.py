"""Small helpers over DataFrames that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import written

# A side of at most this many narrow rows (ids or hashes; under 64 MB) may be broadcast.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(left: DataFrame, right: DataFrame, key: str | list[str], how: str, rows: int) -> DataFrame:
    """``left`` joined to a stored ``right`` of ``rows`` narrow rows.

    The right side is broadcast when its size allows, and shuffled otherwise.
    """
    return left.join(F.broadcast(right) if rows <= BROADCAST_ROWS else right, key, how)


def in_arrow(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``df.mapInArrow(work, schema)`` whose workers give their memory back after each task.

    Python workers live on between tasks; without this they keep the most that any task of
    any operator took, beside the executor's heap.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library has its own ways
            pass

    return df.mapInArrow(task, schema)


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``docs`` after _row, a number that no other row has.

    Stored, so that every scan sees the same numbers.
    """
    return written(docs.select(F.monotonically_increasing_id().alias("_row"), *columns))


def long_lists(arrays: list[np.ndarray]) -> pa.Array:
    """A list<int64> column from arrays of 64-bit integers."""
    offsets = np.zeros(len(arrays) + 1, dtype=np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def held_out(doc_id: str, modulus: int, remainder: int):
    """True for rows whose crc32 of the id, as text, leaves ``remainder``."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == remainder, F.lit(False))
