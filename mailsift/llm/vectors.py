"""Vectors as rows and as blocks: what the two vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# For tables whose rows are blocks. Parquet's writer else holds 100 rows before it looks at their size, and
# a reader holds whole row groups.
LARGE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1"}


def usable(rows: DataFrame, id_col: str, vector_col: str, work) -> tuple[DataFrame, int]:
    """(id, vector) of the vectors that take part, and their dimension.

    Left out: null ids, null vectors, null or non-finite components, zero vectors,
    and vectors of another length than most have. Of several rows with one id the
    least vector counts.
    """
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("vector", lambda x: x != 0)
    good = (
        rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"))
        .where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & nonzero)
    )
    lengths = good.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows"))
    top = lengths.orderBy(F.desc("rows"), "n").first()
    n = top.n if top else 0
    once = good.where(F.size("vector") == n).groupBy("id").agg(F.min("vector").alias("vector"))
    return work.keep(once), n


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=float).reshape(len(column), width)


def blob_matrix(blob: bytes, width: int) -> np.ndarray:
    return np.frombuffer(blob, float).reshape(-1, width)
