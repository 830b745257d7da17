"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsift.llm.common import Work


def components(links: DataFrame, work: Work) -> DataFrame:
    """(node, root) of every node that is not the root of its component itself.

    ``links`` holds pairs (a, b) of any ordered type; the root is the smallest
    node. Stars are rebuilt in turns: every node hangs its larger neighbours on
    the smallest node it knows, then its smaller ones. The number of rounds
    grows with the logarithm of the longest path. A node with very many links
    is met by aggregates and joins only, never gathered in one row.
    """
    stars = work.keep(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
        .distinct()
    )
    while not _settled(stars):
        stars = work.keep(_small_star(_large_star(stars)))
    return stars


def _settled(stars: DataFrame) -> bool:
    """Every node has one root, and no root hangs on another."""
    total = stars.agg(F.count("*"), F.count_distinct("node")).first()
    if total[0] != total[1]:
        return False
    roots = stars.select(F.col("root").alias("node")).distinct()
    return stars.join(roots, "node", "left_semi").isEmpty()


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(
        stars.select(F.col("root").alias("u"), F.col("node").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.where(F.col("v") > F.col("u")).join(least, "u")
        .select(F.col("v").alias("node"), F.col("m").alias("root"))
        .where(F.col("node") != F.col("root"))
        .distinct()
    )


def _small_star(stars: DataFrame) -> DataFrame:
    least = stars.groupBy("node").agg(F.min("root").alias("m"))
    joined = stars.join(least, "node")
    return (
        joined.select("node", F.col("m").alias("root"))
        .unionByName(joined.where(F.col("root") != F.col("m")).select(F.col("root").alias("node"), F.col("m").alias("root")))
        .distinct()
    )
