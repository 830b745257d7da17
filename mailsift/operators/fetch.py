"""Bytes for chosen rows of a staged table, without moving the others.

Winners are picked on keys alone. To pick up their bytes by a join, every
staged mail would have to be shuffled. Instead the row positions travel to the
files: one task opens a staged file and gives out the rows chosen from it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from mailsift.sources import storage

_BATCH_BYTES = 4 << 20
_BUFFER_BYTES = 1 << 20  # of a column read at once; without it a whole column of a row group is
# Row groups of staged files. Where nothing is chosen from one, it is not read.
ROW_GROUP_BYTES = 16 << 20


def fetch_rows(
    chosen: DataFrame, folder: str, schema: T.StructType, columns: list[str], tasks: int
) -> DataFrame:
    """The ``columns`` of the rows named by ``(stage_file, stage_row)``.

    The positions collected for a file are bounded by the rows of a file,
    which the writer caps (``MAX_FILE_ROWS``).
    """
    wanted = T.StructType([schema[c] for c in columns])
    arrow = to_arrow_schema(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column("stage_file").to_pylist()
            for number, name in enumerate(files):
                positions = batch.column("positions")[number].values.to_numpy(zero_copy_only=False)
                yield from _rows_of(f"{folder}/{name}", positions, columns, arrow)

    return (
        chosen.groupBy("stage_file")
        .agg(F.collect_list("stage_row").alias("positions"))
        .repartition(tasks)  # files go out in turn; the rows are tiny, the work is not
        .mapInArrow(run, wanted)
    )


def _rows_of(path: str, positions, columns: list[str], arrow: pa.Schema):
    import numpy as np

    positions = np.sort(positions)
    with storage.open_seekable(path) as file:
        table = pq.ParquetFile(file, pre_buffer=False, buffer_size=_BUFFER_BYTES)
        start = 0
        for group in range(table.num_row_groups):
            meta = table.metadata.row_group(group)
            rows = meta.num_rows
            batch_rows = max(1, min(4096, _BATCH_BYTES * rows // max(meta.total_byte_size, 1)))
            lo, hi = np.searchsorted(positions, [start, start + rows])
            if lo == hi:  # nothing chosen from this row group: not read
                start += rows
                continue
            at = start
            for batch in table.iter_batches(batch_rows, row_groups=[group], columns=columns):
                lo, hi = np.searchsorted(positions, [at, at + batch.num_rows])
                if hi > lo:
                    picked = batch.select(columns)
                    if hi - lo < batch.num_rows:
                        picked = picked.take(pa.array(positions[lo:hi] - at))
                    yield picked.cast(arrow)
                at += batch.num_rows
            start += rows
