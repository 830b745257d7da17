"""Hot folders and keys: the work spreads, and only keys move."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from mailsift import DEFAULT, Options
from mailsift.functions.formats import Format
from mailsift.operators.first_wins import dedup_counts, first_wins, without_known
from mailsift.operators.sql import register_reader, register_table_functions
from mailsift.plans.ingest import _spread
from tests.trees import locked, mbox, zipped


def listing(spark, rows):
    """Half of all bytes in one folder, the rest in many small ones."""
    hot = F.col("id") < rows // 2
    return spark.range(rows).select(
        F.concat(F.lit("f"), "id").alias("path"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 50)).alias("namespace"),
        F.lit("2024-07-15").alias("date_partition"),
        F.lit(1 << 20).cast("bigint").alias("size"),
    )


def test_a_hot_folder_goes_to_many_tasks_and_small_ones_stay_whole(spark):
    spread = _spread(listing(spark, 4000), Options(task_bytes=32 << 20))
    tasks = spread.withColumn("task", F.spark_partition_id())
    per_task = [r["count"] for r in tasks.groupBy("task").count().collect()]
    assert sum(per_task) == 4000 and max(per_task) < 4000 / 8
    homes = {
        r.namespace: r.n
        for r in tasks.groupBy("namespace").agg(F.count_distinct("task").alias("n")).collect()
    }
    assert homes["hot"] > 20
    assert all(n <= 2 for name, n in homes.items() if name != "hot")


def keys(spark, rows=2000):
    return spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("uid"),
        F.lit("ns").alias("namespace"),
        F.lit("d").alias("date_partition"),
        F.col("id").cast("string").alias("source_file"),
        F.array(F.col("id")).alias("entry_ord"),
    )


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_are_combined_before_the_shuffle(spark):
    plan = plan_of(first_wins(keys(spark)))
    assert plan.index("partial_min") > plan.index("Exchange")  # below it, that is before it
    assert len(re.findall("Exchange", plan)) == 1


def test_few_new_keys_do_not_shuffle_the_ledger(spark):
    ledger = spark.range(100_000).select(F.col("id").cast("string").alias("uid"))
    best = first_wins(keys(spark))
    small, large = (without_known(best, ledger, "uid", small=s) for s in (True, False))
    assert sorted(r.uid for r in small.collect()) == sorted(r.uid for r in large.collect()) == ["hot"]
    assert "BroadcastHashJoin [uid" in plan_of(small)


def test_counts_add_up_in_groups_without_a_winner(spark):
    rows = keys(spark, 30).withColumn("namespace", F.col("uid"))
    winners = first_wins(rows).filter(F.col("uid") != "hot")
    got = {r.namespace: (r.leaves, r.processed, r.deduplicated) for r in dedup_counts(rows, winners, ["namespace"]).collect()}
    assert got["hot"] == (10, 0, 10) and got["1"] == (1, 1, 0)


def test_readers_in_sql(spark):
    register_table_functions(spark)
    register_reader(spark, Format("halves", (".halves",), "container", True, lambda c: [("a", c[:1]), ("b", c[1:])]))
    files = spark.createDataFrame(
        [(zipped(("a.eml", b"1"), ("x.png", b"2")), "z"), (locked(zipped(("b.eml", b"3"))), "l"), (b"junk", "j")],
        "content binary, f string",
    )
    got = spark.sql(
        "SELECT f, e.kind, e.entry_name, e.reason, e.payload FROM {files}, LATERAL unpack_zip(content) AS e", files=files
    ).collect()
    assert {tuple(r) for r in got} == {
        ("z", "entry", "a.eml", None, b"1"),
        ("z", "entry", "x.png", None, b"2"),
        ("l", "skip", "b.eml", "password_protected", None),
        ("j", "skip", None, "corrupted", None),
    }
    box = spark.createDataFrame([(mbox(b"S: x\n\nb\n"),)], "content binary")
    assert spark.sql("SELECT m.payload FROM {box}, LATERAL unpack_mbox(content) AS m", box=box).first()[0] == b"S: x\n\nb\n"
    pair = spark.createDataFrame([(b"pq",)], "content binary")
    halves = spark.sql("SELECT h.payload FROM {pair}, LATERAL unpack_halves(content) AS h", pair=pair).collect()
    assert sorted(bytes(r[0]) for r in halves) == [b"p", b"q"]
    assert DEFAULT.of("x.halves") is None
