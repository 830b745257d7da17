"""The readers as table functions, for use in SQL with LATERAL.

Spark joins laterally only with functions that are called row by row; values
still travel in Arrow batches.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from mailsift.functions import naming
from mailsift.functions.formats import SINGLE, Format, Formats
from mailsift.operators import entries
from mailsift.operators.entries import Item, Limits

_SHAPE = (
    "kind string, ord bigint, entry_name string, message_index bigint, message_id string, reason string, payload binary"
)
_EVERY = Formats((Format("any", ("",), SINGLE, True),))


def _row(item: Item) -> tuple:
    kind = "entry" if item.kind == "entry" else "skip"
    name = item.name
    if name is None and item.index is not None:
        name = naming.message_name(item.message_id, item.index)
    return kind, item.ord, name, item.index, item.message_id, item.reason, item.payload


def _register(spark: SparkSession, name: str, items: Callable[[bytes], Iterator[Item]]) -> None:
    class Unpack:
        def eval(self, content: bytes):
            if content is not None:
                yield from map(_row, items(bytes(content)))

    spark.udtf.register(name, udtf(Unpack, returnType=_SHAPE, useArrow=True))


def register_table_functions(spark: SparkSession) -> None:
    """``SELECT ... FROM files, LATERAL unpack_zip(content)``, and ``unpack_mbox``."""
    _register(spark, "unpack_zip", lambda content: entries.zip_items(io.BytesIO(content), _EVERY, Limits()))
    _register(spark, "unpack_mbox", entries.mbox_items)


def register_reader(spark: SparkSession, fmt: Format) -> None:
    """A registered container format as ``unpack_<name>``."""
    reader = fmt.reader
    _register(spark, f"unpack_{fmt.name}", lambda content: entries.own_reader_items(content, reader, _EVERY))
