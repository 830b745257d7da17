"""The bucket: ``<namespace>/timestamp=YYYY-MM-DD/<file>``.

Listing runs on the executors, one folder per row, so neither the driver nor
one task holds the tree. It sees what a directory listing sees, zero-byte files
and names starting with ``_`` included (Spark's own file index leaves both out).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from mailsift.functions import naming
from mailsift.functions.formats import DEFAULT, Formats
from mailsift.functions.records import content_hash
from mailsift.schemas import LISTING
from mailsift.sources import storage

# Fixed value: the name of a date folder.
DATE_FOLDER = re.compile(r"timestamp=(\d{4}-\d{2}-\d{2})")
_ROWS = 2000


def _namespaces_below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for root in batch.column("root").to_pylist():
            names = [
                e.name for e in storage.list_dir(root) if e.is_dir and not e.name.startswith(".")
            ]
            yield pa.RecordBatch.from_pydict(
                {"root": [root] * len(names), "namespace": names},
                schema=pa.schema([("root", pa.string()), ("namespace", pa.string())]),
            )


def _dates_below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, pa.string()) for n in ("root", "namespace", "date_partition")])
    for batch in batches:
        for row in batch.to_pylist():
            dates = [
                found.group(1)
                for e in storage.list_dir(f"{row['root']}/{row['namespace']}")
                if e.is_dir and (found := DATE_FOLDER.fullmatch(e.name))
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "root": [row["root"]] * len(dates),
                    "namespace": [row["namespace"]] * len(dates),
                    "date_partition": dates,
                },
                schema=schema,
            )


def _files_below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = to_arrow_schema(LISTING)
    for batch in batches:
        for row in batch.to_pylist():
            namespace, date = row["namespace"], row["date_partition"]
            folder = f"{namespace}/timestamp={date}"
            found = (e for e in storage.list_dir(f"{row['root']}/{folder}") if not e.is_dir and not e.name.startswith("."))
            while some := list(islice(found, _ROWS)):
                paths = [f"{folder}/{entry.name}" for entry in some]
                columns = {
                    "path": paths,
                    "namespace": [namespace] * len(some),
                    "date_partition": [date] * len(some),
                    "source_file": [entry.name for entry in some],
                    "location": [f"{row['root']}/{path}" for path in paths],
                    "size": [entry.size for entry in some],
                    "modified_at": [entry.modified_at for entry in some],
                }
                yield pa.RecordBatch.from_pydict(columns, schema=schema)


def _roots(spark: SparkSession, root: str) -> DataFrame:
    return spark.range(1).select(F.lit(root.rstrip("/")).alias("root"))


def _width(spark: SparkSession) -> int:
    """Tasks for listing. Named outright: the rows are tiny, and left to itself
    adaptive execution would put all folders into one task."""
    return spark.sparkContext.defaultParallelism * 2


def list_namespaces(spark: SparkSession, root: str) -> DataFrame:
    """Namespaces: folders below the root that are not hidden."""
    return _roots(spark, root).mapInArrow(_namespaces_below, "root string, namespace string")


def list_date_partitions(
    spark: SparkSession, root: str, namespaces: Iterable[str] | None = None
) -> DataFrame:
    """Date folders of all namespaces, or of the given ones."""
    if namespaces is None:
        found = list_namespaces(spark, root)
    else:
        names = F.explode(F.array(*[F.lit(n) for n in namespaces]))
        found = _roots(spark, root).select("root", names.alias("namespace"))
    return found.repartition(_width(spark), "namespace").mapInArrow(
        _dates_below, "root string, namespace string, date_partition string"
    )


def list_files(
    spark: SparkSession,
    root: str,
    namespaces: Iterable[str] | None = None,
    dates: Iterable[str] | None = None,
    formats: Formats = DEFAULT,
) -> DataFrame:
    """Files of the bucket with size and time, without their bytes.

    ``namespaces`` and ``dates`` keep whole folders from being listed.
    """
    folders = list_date_partitions(spark, root, namespaces)
    if dates is not None:
        folders = folders.filter(F.col("date_partition").isin([str(d) for d in dates]))
    # Large folders are few, so many tasks keep two of them from falling into one.
    wide = folders.repartition(4 * _width(spark), "namespace", "date_partition")
    found = wide.mapInArrow(_files_below, LISTING)
    return found.withColumn("format", formats.detect(F.col("source_file")))


def list_unseen(files: DataFrame, formats: Formats = DEFAULT) -> DataFrame:
    """Files that Spark's file index leaves out, in the folders of the given files."""
    root = F.expr("substring(location, 1, length(location) - length(path) - 1)").alias("root")
    folders = files.select(root, "namespace", "date_partition").distinct()
    found = folders.mapInArrow(_files_below, LISTING)
    unseen = (F.col("size") == 0) | F.startswith("source_file", F.lit("_"))
    return found.where(unseen).withColumn("format", formats.detect(F.col("source_file")))


def file_stat(listing: DataFrame) -> DataFrame:
    return listing.select("path", "size", "modified_at")


def file_exists(spark: SparkSession, root: str, namespace: str, date: str, name: str) -> DataFrame:
    """One row saying whether the file is there."""
    found = list_files(spark, root, [namespace], [date]).filter(F.col("source_file") == name)
    return found.agg((F.count(F.lit(1)) > 0).alias("file_exists"))


def relative(path: Column, root: str) -> Column:
    """Path below the root, for paths as Spark's file sources give them."""
    bare = re.sub(r"^file:(//)?(?=/)", "", root.rstrip("/"))
    return F.regexp_replace(
        F.regexp_replace(path, r"^file:(//)?(?=/)", ""), "^" + _quote(bare) + "/+", ""
    )


def _quote(text: str) -> str:
    return "".join(c if c.isalnum() or c in "/_" else "\\" + c for c in text)


def with_bucket_columns(files: DataFrame, root: str, formats: Formats = DEFAULT) -> DataFrame:
    """Turn ``binaryFile`` rows into bucket files; rows off the layout are left out.

    A glob also returns files in subfolders and in hidden namespaces, so the
    layout is checked on the path.
    """
    rel = files.withColumn("path", relative(F.col("path"), root)).filter(
        F.col("path").rlike(naming.BUCKET_FILE)
    )
    return (
        rel.withColumn("namespace", naming.namespace_of(F.col("path")))
        .withColumn("date_partition", naming.date_of(F.col("path")))
        .withColumn("source_file", naming.file_of(F.col("path")))
        .withColumn("format", formats.detect(F.col("source_file")))
        .withColumnRenamed("length", "size")
        .withColumnRenamed("modificationTime", "modified_at")
    )


def scan_binary(
    spark: SparkSession,
    root: str,
    namespace: str = "*",
    date: str = "*",
    formats: Formats = DEFAULT,
) -> DataFrame:
    """Files with their bytes through Spark's ``binaryFile`` source.

    A named namespace or date narrows the path, so other folders are not
    listed; without ``content`` in the query no bytes are read. Zero-byte files
    and names starting with ``_`` are not seen by this source.
    """
    # The glob ends at the folders: expanding it to files is the driver's work.
    files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{namespace}/timestamp={date}")
    return with_bucket_columns(files, root, formats)


def with_hash(files: DataFrame) -> DataFrame:
    return files.withColumn("content_hash", content_hash(F.col("content")))
