"""Which files of a compacted ledger table can hold a key: a Bloom filter in blocks, and a directory.

Both are small tables beside the compacted one. The filter has one row of 256 bits
per block; a key belongs to one block and sets two bits in each of its four words, so a
test is one equality join and reads an eighth or less of what the keys take. With 32 bits a key, one
unknown key in some tens of thousands passes. The directory says which file holds which
beginnings of keys, from where to where. Null keys are in neither, as nothing equals them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsift.sources import storage

KEYS_PER_BLOCK = 8  # 256 bits for them
WORDS = 4
PREFIX = 3  # characters of a key that the directory goes by: at most 4,096 values of a hash in hexadecimal


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def _masks(key: Column) -> list[Column]:
    """The bits of a key, by word: six bits of another hash say where each is."""
    spots = F.xxhash64(F.lit("spots"), key)

    def bit(number: int) -> Column:
        at = F.shiftrightunsigned(spots, 6 * number).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), at)

    return [bit(2 * word).bitwiseOR(bit(2 * word + 1)) for word in range(WORDS)]


def write_filter(rows: DataFrame, key: str, place: str) -> None:
    """Filter and directory of a table as it has been read from its files."""
    keys = rows.select(F.col(key).alias("key"), F.col("_metadata.file_name").alias("file")).where("key IS NOT NULL")
    count = keys.count()
    blocks = F.lit(max(1, -(-count // KEYS_PER_BLOCK)))
    words = [mask.alias(f"word{i}") for i, mask in enumerate(_masks(F.col("key")))]
    (
        keys.select(_block(F.col("key"), blocks).alias("block"), *words)
        .groupBy("block").agg(*[F.bit_or(f"word{i}").alias(f"word{i}") for i in range(WORDS)])
        .withColumn("blocks", blocks.cast("long")).write.parquet(f"{place}/blocks")
    )
    (
        keys.groupBy(F.substring("key", 1, PREFIX).alias("prefix"), "file")
        .agg(F.min("key").alias("least"), F.max("key").alias("most")).write.parquet(f"{place}/files")
    )


def has_filter(place: str) -> bool:
    return any(entry.name == "_SUCCESS" for entry in storage.list_dir(f"{place}/files"))


def passing(spark: SparkSession, place: str, keys: DataFrame) -> DataFrame:
    """Of the keys (one column, few enough to be broadcast), those that the table can hold: key."""
    filed = spark.read.parquet(f"{place}/blocks")
    blocks = filed.agg(F.max("blocks")).first()[0]
    at_hand = keys.toDF("key").where("key IS NOT NULL").distinct()
    if blocks is None:
        return at_hand.limit(0)
    asked = at_hand.select("key", _block(F.col("key"), F.lit(blocks)).alias("block"))
    held = filed.drop("blocks").join(F.broadcast(asked), "block")
    for i, mask in enumerate(_masks(F.col("key"))):
        held = held.where(F.col(f"word{i}").bitwiseAND(mask) == mask)
    return held.select("key")


def files_with(spark: SparkSession, place: str, keys: DataFrame) -> list[str]:
    """Names of the files that can hold any of the keys. There are no more names than files."""
    passed = passing(spark, place, keys).withColumn("prefix", F.substring("key", 1, PREFIX))
    found = spark.read.parquet(f"{place}/files").join(passed, "prefix").where("key BETWEEN least AND most")
    return [row.file for row in found.select("file").distinct().orderBy("file").collect()]
