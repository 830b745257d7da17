"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Settings the jobs rely on. Rows may carry whole files, so few of them travel
# to Python in one Arrow batch.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # Else shuffle files stay until the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# Of staged tables and of the output. Keys are hashes in hexadecimal, which the default codec leaves as long as they
# are; at level 1 this one takes no more time than that.
# Columns whose values hardly repeat: a dictionary of them is built in each row group only to be given up.
_OWN_VALUES = ("uid", "content_hash", "location", "output_path", "content", "mail", "box")
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"} | {
    f"parquet.enable.dictionary#{name}": "false" for name in _OWN_VALUES
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session and give its workers the package."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application."""
    context = spark.sparkContext
    if getattr(context, "_mailsift_shipped", False):
        return
    here = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="mailsift-code-")) / "mailsift.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(here.rglob("*.py")):
            archive.write(source, Path(here.name) / source.relative_to(here))
    context.addPyFile(str(target))
    context._mailsift_shipped = True


def build(app: str = "mailsift", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a table that comes in fewer splits than that.

    For rows that go through Python. A large table has splits enough and is
    left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty table. One made of a Python list would start Python workers on all cores to carry nothing."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(0, 0, 1, 1).select(*columns)


def work_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Folder for intermediate tables, shared by all executors.

    It is the one the cluster names in ``spark.checkpoint.dir``. Where that is
    unset, ``fallback`` (a folder under the output root) is used; a local
    temporary folder serves only single-machine sessions.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if fallback:
        return fallback.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="mailsift-")


def new_work_dir(spark: SparkSession, fallback: str | None = None) -> str:
    return f"{work_root(spark, fallback)}/mailsift-{uuid.uuid4().hex}"
