"""Unpacking: containers to entries, one level at a time, to any depth.

One driver-side step per nesting level. Each level is a table in the shared
work folder, so nothing is parsed twice and a lost executor costs one task.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from mailsift.functions import naming
from mailsift.functions.formats import CONTAINER, DEFAULT, SINGLE, Format, Formats, skip_reason
from mailsift.operators import entries
from mailsift.operators.entries import Item, Limits
from mailsift.operators.fetch import ROW_GROUP_BYTES
from mailsift.schemas import FOUND, ORD
from mailsift.session import PACKED

_ITEM = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("ord", T.LongType()),
        T.StructField("entry_name", T.StringType()),
        T.StructField("message_id", T.StringType()),
        T.StructField("message_index", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("uid", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("spill", T.StringType()),
        T.StructField("cut", T.LongType()),
        T.StructField("may_attach", T.BooleanType()),
    ]
)
_ITEM_ARROW = [(f.name, to_arrow_type(f.dataType)) for f in _ITEM]
_FLUSH_BYTES, _FLUSH_ROWS = 16 << 20, 1024
_FLUSH_PARTS = 16_384

# Bounds the row positions that fetching collects for one staged file.
MAX_FILE_ROWS = 200_000
MAX_TASKS = 100_000
_TASK_BYTES = 64 << 20
_RUN_BYTES = 8 << 20  # of consecutive parts of a file that are read in one go

# Columns that place a row in the corpus; they pass through unpacking.
PLACE = ["path", "namespace", "date_partition", "source_file", "entry_ord", "container_path", "ancestors"]


def expand(
    df: DataFrame, keep: list[str], use: list[str], items: Callable[..., Iterator[Item]]
) -> DataFrame:
    """One row in, many out. ``items`` gets the ``use`` columns of a row.

    The ``keep`` columns are repeated in Arrow without becoming Python objects,
    and output leaves in batches of bounded size, so a container's entries
    never pile up in the worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [batch.column(name) for name in keep]
            used = [batch.column(name) for name in use]
            parents: list[int] = []
            rows: list[Item] = []
            filled = 0
            for number in range(batch.num_rows):
                for item in items(*(column[number].as_py() for column in used)):
                    parents.append(number)
                    rows.append(item)
                    filled += len(item.payload) if item.payload is not None else 0
                    if filled >= _FLUSH_BYTES or len(rows) >= _FLUSH_ROWS:
                        yield _to_batch(kept, keep, parents, rows)
                        parents, rows, filled = [], [], 0
            if rows:
                yield _to_batch(kept, keep, parents, rows)

    schema = T.StructType([df.schema[name] for name in keep] + list(_ITEM.fields))
    columns = list(dict.fromkeys([*keep, *use]))
    return df.select(*columns).mapInArrow(run, schema)


def _to_batch(kept, keep, parents, rows) -> pa.RecordBatch:
    index = pa.array(parents, pa.int32())
    arrays = [column.take(index) for column in kept]
    for (_, kind), values in zip(_ITEM_ARROW, zip(*rows)):
        arrays.append(pa.array(values, kind))
    return pa.RecordBatch.from_arrays(arrays, names=[*keep, *(n for n, _ in _ITEM_ARROW)])


# -- single operators ------------------------------------------------------


def unzip(
    df: DataFrame, content: str = "content", keep: list[str] | None = None, formats: Formats = DEFAULT
) -> DataFrame:
    """Entries of the archive in ``content``, with the skips as rows of their own.

    Adds ``kind`` (entry or skip), ``ord``, ``entry_name``, ``reason``, ``payload``.
    Every entry's bytes are given, whatever its format.
    """
    keep = [c for c in df.columns if c != content] if keep is None else keep
    found = expand(
        df, keep, [content], lambda c: entries.zip_items(io.BytesIO(c), _EVERY, Limits())
    )
    return found.select(
        *keep,
        F.when(F.col("kind") == "entry", "entry").otherwise("skip").alias("kind"),
        "ord",
        "entry_name",
        "reason",
        "payload",
    )


# A set in which every entry of an archive is wanted as it is.
_EVERY = Formats((Format("any", ("",), SINGLE, True),))


def split_mbox(
    df: DataFrame, content: str = "content", keep: list[str] | None = None, raw_mbox: bool = False
) -> DataFrame:
    """Messages of the mailbox in ``content``.

    Adds ``kind``, ``ord`` (byte offset), ``message_index`` (from 0),
    ``message_id``, ``entry_name``, ``reason``, ``payload``.
    """
    keep = [c for c in df.columns if c != content] if keep is None else keep
    found = expand(df, keep, [content], lambda c: entries.mbox_items(c, raw_mbox))
    return found.select(
        *keep,
        F.when(F.col("kind") == "entry", "entry").otherwise("skip").alias("kind"),
        "ord",
        "message_index",
        "message_id",
        naming.mbox_entry_name(F.col("message_id"), F.col("message_index")).alias("entry_name"),
        "reason",
        "payload",
    )


# -- the shape every level ends in -----------------------------------------


def _shape(found: DataFrame, formats: Formats) -> DataFrame:
    """Names, lineage and routing of raw items, as built-in expressions."""
    kind = F.col("kind")
    own = kind.isin("source", "self") | (F.col("ord").isNull())
    below = kind.isin("entry", "refused") & ~own
    entry_name = F.coalesce(
        "entry_name", naming.mbox_entry_name(F.col("message_id"), F.col("message_index"))
    )
    name = (
        F.when(own, F.col("source_file"))
        .when(below, entry_name)
        .otherwise(F.coalesce(F.try_element_at("container_path", F.lit(-1)), F.col("source_file")))
    )
    fmt = formats.detect(F.col("name"))
    file_type = formats.file_type(F.col("format"))
    readable = formats.is_supported(F.col("format"))
    routed = (
        F.when(kind == "source", "source")
        .when(kind.isin("refused", "broken"), "skip")
        .when(readable & (file_type == SINGLE), "leaf")
        .when(readable & F.array_contains("ancestors", F.col("uid")), "skip")
        .when(readable & (file_type == CONTAINER), "box")
        .otherwise("skip")
    )
    return (
        found.withColumn("name", name)
        .withColumn("format", fmt)
        .withColumn("routed", routed)
        .select(
            "path",
            "namespace",
            "date_partition",
            "source_file",
            F.when(own, F.col("entry_ord"))
            .otherwise(F.array_append("entry_ord", F.col("ord")))
            .alias("entry_ord"),
            F.when(below, F.array_append("container_path", F.col("name")))
            .otherwise(F.col("container_path"))
            .alias("container_path"),
            # Digests of the containers around what a box holds, itself included.
            F.when(F.col("routed") == "box", F.array_append("ancestors", F.col("uid")))
            .otherwise(F.col("ancestors"))
            .alias("ancestors"),
            "name",
            "format",
            F.col("routed").alias("kind"),
            F.when(
                F.col("routed") == "skip",
                F.coalesce("reason", F.when(readable, "contains_itself"), skip_reason(F.col("format"))),
            ).alias("reason"),
            "uid",
            "size",
            (F.col("may_attach") & (F.col("format") == "eml")).alias("may_attach"),
            F.when(F.col("routed") == "leaf", F.col("payload")).alias("mail"),
            F.when(F.col("routed") == "box", F.col("payload")).alias("box"),
            "spill",
            "cut",
        )
    )


def _empty(kind: T.DataType) -> Column:
    return F.array().cast(kind)


def _placed(files: DataFrame) -> DataFrame:
    texts = T.ArrayType(T.StringType())
    return (
        files.withColumn("entry_ord", _empty(ORD))
        .withColumn("container_path", _empty(texts))
        .withColumn("ancestors", _empty(texts))
    )


def open_stored(files: DataFrame, formats: Formats, limits: Limits) -> DataFrame:
    """Bucket files by their location: each read once, in the task that unpacks it."""
    found = expand(
        _placed(files),
        PLACE,
        ["location", "source_file", "size"],
        lambda where, name, size: entries.file_items(where, None, name, size, formats, limits),
    )
    return _shape(found, formats)


def open_inline(files: DataFrame, formats: Formats, limits: Limits) -> DataFrame:
    """Bucket files whose bytes are in the ``content`` column, in one pass over them."""
    found = expand(
        _placed(files),
        PLACE,
        ["content", "source_file"],
        lambda content, name: entries.file_items(
            None, content, name, len(content), formats, limits
        ),
    )
    return _shape(found, formats)


def open_boxes(boxes: DataFrame, formats: Formats, limits: Limits) -> DataFrame:
    """Nested containers whose bytes are in the ``box`` column."""
    found = expand(
        boxes,
        PLACE,
        ["box", "format"],
        lambda content, fmt: entries.box_items(content, fmt, formats, limits),
    )
    return _shape(found, formats)


def survey_large(large: DataFrame, part: int) -> DataFrame:
    """Hash and parts of large containers: one row each, with a list of parts.

    SHA-256 is sequential, so this is one task per file; reading the parts is not.
    """
    schema = T.StructType(
        [
            *(f for f in large.schema if f.name not in ("content_hash", "size")),
            T.StructField("content_hash", T.StringType()),
            T.StructField("size", T.LongType()),
            T.StructField("parts", T.ArrayType(_PART)),
        ]
    )
    keep = [f.name for f in schema.fields[:-3]]

    kinds = [pa.string(), pa.int64(), to_arrow_type(schema["parts"].dataType)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, filled, rows = 0, 0, []
            places, names = batch.column("location"), batch.column("format")
            for number in range(batch.num_rows):
                rows.append(entries.survey(places[number].as_py(), names[number].as_py(), part))
                filled += len(rows[-1][2])
                if filled >= _FLUSH_PARTS or number + 1 == batch.num_rows:
                    kept = [batch.column(name).slice(start, len(rows)) for name in keep]
                    own = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays([*kept, *own], names=schema.names)
                    start, filled, rows = number + 1, 0, []

    return large.select(*keep).mapInArrow(run, schema)


_PART = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("base", T.LongType()),
    ]
)


def open_parts(surveyed: DataFrame, formats: Formats, limits: Limits) -> DataFrame:
    """Large containers part by part: the parts of one file spread over all tasks, small ones
    in runs of consecutive parts for which the file is opened once."""
    count = surveyed.agg(F.coalesce(F.sum(F.size("parts")), F.lit(0))).first()[0]
    cores = surveyed.sparkSession.sparkContext.defaultParallelism
    tasks = min(max(count * limits.part // _TASK_BYTES, cores), MAX_TASKS)
    many = max(1, _RUN_BYTES // limits.part)
    runs = F.expr(
        f"transform(sequence(0, greatest(size(parts) - 1, 0), {many}), at -> slice(parts, at + 1, {many}))"
    )
    parts = surveyed.select(*PLACE, "location", "format", F.explode(runs).alias("run"))
    found = expand(
        parts.repartition(tasks),  # in turn, so that every task gets its share
        PLACE,
        ["location", "format", "run"],
        lambda where, fmt, run: entries.part_items(where, fmt, run, formats, limits),
    )
    return _shape(found, formats)


def read_mailboxes(listing: DataFrame, work: str, part: int = 64 << 20) -> DataFrame:
    """Messages of the mailboxes of a listing, a large one read by many tasks."""
    spark = listing.sparkSession
    boxes = _placed(listing.filter(F.col("format") == "mbox"))
    wide = boxes.repartition(spark.sparkContext.defaultParallelism * 4, "path")
    survey_large(wide, part).write.mode("overwrite").parquet(work)
    found = open_parts(spark.read.parquet(work), DEFAULT, Limits(part=part))
    return found.filter(F.col("kind") == "leaf").select(
        *PLACE, F.col("name").alias("entry_name"), "uid", F.col("mail").alias("payload")
    )


# -- recursion -------------------------------------------------------------


def stage_writer(rows: DataFrame) -> DataFrameWriter:
    """For rows with bytes, of which chosen ones are fetched later."""
    writer = rows.write.mode("overwrite").options(maxRecordsPerFile=MAX_FILE_ROWS, **PACKED)
    return writer.option("parquet.block.size", ROW_GROUP_BYTES)


class Found:
    """What unpacking found, level by level, in the work folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.levels: list[str] = []
        self.boxes = self.spilled = 0  # containers the last level has found
        self._cuts: list[DataFrame] = []

    def add_level(self, rows: DataFrame) -> None:
        target = f"{self.folder}/level-{len(self.levels)}"
        stage_writer(rows).parquet(target)
        self.levels.append(target)
        staged = self.spark.read.schema(FOUND).parquet(target)
        cut, box = F.col("cut").isNotNull(), F.col("kind") == "box"
        seen = staged.agg(
            F.count_if(box).alias("boxes"),
            F.count_if(box & F.col("spill").isNotNull()).alias("spilled"),
            F.count_if(cut).alias("cuts"),
        ).first()
        self.boxes, self.spilled = seen["boxes"], seen["spilled"]
        if seen["cuts"]:
            # An archive read in parts ends at its first damage, like one read whole.
            archive = F.expr("slice(entry_ord, 1, size(entry_ord) - 1)").alias("archive_ord")
            self._cuts.append(
                staged.filter(cut).groupBy("path", archive).agg(F.min("cut").alias("cut"))
            )

    def _read(self, *levels: str) -> DataFrame:
        rows = (
            self.spark.read.schema(FOUND)
            .parquet(*levels)
            .withColumn("stage_file", F.regexp_extract("_metadata.file_path", r"(level-\d+/[^/]+)$", 1))
            .withColumn("stage_row", F.col("_metadata.row_index"))
        )
        if not self._cuts:
            return rows
        cuts = reduce(DataFrame.unionByName, self._cuts).select(
            F.col("path").alias("cut_path"), "archive_ord", F.col("cut").alias("cut_at")
        )
        beyond = (
            (F.col("path") == F.col("cut_path"))
            & (F.expr("slice(entry_ord, 1, size(archive_ord))") == F.col("archive_ord"))
            & (F.expr("try_element_at(entry_ord, size(archive_ord) + 1)") > F.col("cut_at"))
        )
        return rows.join(cuts, beyond, "left_anti")

    def rows(self, kind: str) -> DataFrame:
        return self._read(*self.levels).filter(F.col("kind") == kind)

    def last(self) -> DataFrame:
        return self._read(self.levels[-1]).filter(F.col("kind") == "box")

    def counts(self) -> dict[str, int]:
        rows = self._read(*self.levels).groupBy("kind").count().collect()
        return {"source": 0, "leaf": 0, "skip": 0} | {r["kind"]: r["count"] for r in rows}

    def sources(self) -> DataFrame:
        return self.rows("source").select(
            "path",
            "namespace",
            "date_partition",
            F.col("source_file").alias("filename"),
            "format",
            F.col("size").alias("size_bytes"),
            F.col("uid").alias("content_hash"),
        )

    def leaves(self) -> DataFrame:
        """Mails without their bytes."""
        return self.rows("leaf").drop("mail", "box", "kind", "reason", "spill", "cut", "ancestors")

    def skips(self) -> DataFrame:
        return self.rows("skip").select(
            naming.skip_path(
                F.col("namespace"),
                F.col("date_partition"),
                F.col("source_file"),
                F.col("container_path"),
            ).alias("path"),
            "reason",
            "namespace",
            "date_partition",
        )


def unpack_all(
    found: Found,
    formats: Formats,
    limits: Limits,
) -> Found:
    """Open nested containers below the levels already found, until none is left,
    however deep they lie. A container with the bytes of one around it would never
    end; it is recorded as ``contains_itself``.
    """
    spark = found.spark
    while True:
        if not found.boxes:
            return found
        boxes = found.last()
        below = open_boxes(boxes.filter(F.col("box").isNotNull()), formats, limits)
        if found.spilled:
            large = boxes.filter(F.col("spill").isNotNull()).select(
                *PLACE, F.col("spill").alias("location"), "format", "size"
            )
            staged = f"{found.folder}/survey-{len(found.levels)}"
            wide = large.repartition(spark.sparkContext.defaultParallelism * 4, "location")
            survey_large(wide, limits.part).write.mode("overwrite").options(**PACKED).parquet(staged)
            below = below.unionByName(open_parts(spark.read.parquet(staged), formats, limits))
        found.add_level(below)
