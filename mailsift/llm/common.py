"""Shared by the operators of this subpackage: tables, work folder, limits."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsift import session

# Bytes of text that one vectorised step inside a task looks at.
STEP_BYTES = 4 << 20

# What may be broadcast or collected at most; beyond it the operators go
# another way.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Work:
    """A folder below ``spark.checkpoint.dir`` for the written tables of one call.

    Tables written here cut the lineage and outlive a lost executor. The folder
    goes when the application ends, as results read from it lazily.
    """

    def __init__(self, spark: SparkSession):
        self.spark = session.tune(spark)
        self.root = session.new_work_dir(spark)
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
        self._count = 0

    def keep(self, df: DataFrame, **options: str) -> DataFrame:
        """Write a table and read it back."""
        self._count += 1
        path = f"{self.root}/{self._count}"
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


@cache
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Hand memory that is free to the system. A worker lives on and would keep its peak through all later stages."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A step of ``mapInArrow`` whose task gives its memory back when it ends."""

    @wraps(run)
    def lean(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return lean


def text_bytes(column: Column | str = "text") -> Column:
    """Whole text as a string, null as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def unit_hash(key: Column) -> Column:
    """60 bits of the md5 of a key: the same in every engine that has md5."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def steps(batches: Iterable[pa.RecordBatch], column: str, size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``size`` bytes of a column, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        ends = np.cumsum(np.nan_to_num(lengths.astype(float)))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0.0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column end to end, and the offsets of its rows."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]
