"""A training corpus from raw documents: five stages, each on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``. Rows may hold nulls in any column, repeat, or tie; each
operator's module says what it does then. An empty table passes through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsift.llm import bpe, minhash, mixing, suffix_dedup, toxicity
from mailsift.llm.common import Work, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.5; it learns from the table ``labels``."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id."""
    return minhash.without_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that a document with a smaller id holds too."""
    return suffix_dedup.remove_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to it."""
    coded = bpe.encode_decode(docs.select("doc_id", "source", "text"))
    return coded.select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("intact"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("mixing", mix_sources),
    ("bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
