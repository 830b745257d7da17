"""What a Python worker holds does not grow with the tables."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from mailsift import corpus, queries, session
from mailsift.corpus import bytes_of, entry
from mailsift.operators import fetch
from mailsift.operators.unpack import stage_writer
from mailsift.plans.ledger import Ledger
from tests.test_queries import FOLDER

_SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("mail", T.BinaryType())])


def test_fetching_holds_little_of_a_large_row_group(tmp_path):
    path, count = str(tmp_path / "staged.parquet"), 16_000
    mails = [os.urandom(4000) for _ in range(count)]
    table = pa.table({"name": [str(n) for n in range(count)], "mail": mails}, to_arrow_schema(_SCHEMA))
    pq.write_table(table, path, row_group_size=count, use_dictionary=False)  # 64 MB in one row group
    del table
    chosen = list(range(0, count, 3))
    pool = pa.proxy_memory_pool(pa.default_memory_pool())
    usual = pa.default_memory_pool()
    pa.set_memory_pool(pool)
    try:
        at = 0
        for batch in fetch._rows_of(path, chosen, _SCHEMA.names, to_arrow_schema(_SCHEMA)):
            for name, mail in zip(batch.column("name").to_pylist(), batch.column("mail").to_pylist()):
                assert (int(name), mail) == (chosen[at], mails[chosen[at]])
                at += 1
            del batch
    finally:
        pa.set_memory_pool(usual)
    assert at == len(chosen)
    assert pool.max_memory() < 32 << 20


def test_staged_files_have_small_row_groups(spark, tmp_path):
    digests = F.concat(*[F.unhex(F.sha2(F.concat("id", F.lit(f"-{n}")), 512)) for n in range(64)])
    folder = str(tmp_path / "staged")
    stage_writer(spark.range(0, 12_000, 1, 1).select(digests.alias("mail"))).parquet(folder)
    (name,) = [n for n in os.listdir(folder) if n.endswith(".parquet")]
    meta = pq.read_metadata(f"{folder}/{name}")
    assert meta.num_row_groups > 2
    assert max(meta.row_group(n).total_byte_size for n in range(meta.num_row_groups)) < 2 * fetch.ROW_GROUP_BYTES


def test_an_empty_ledger_is_read_without_python(spark, tmp_path, capsys):
    ledger = Ledger(spark, str(tmp_path / "out"))
    for rows in (ledger.read("processed"), ledger.read("emails"), ledger.run_events(), ledger.snapshot()):
        assert rows.count() == 0
        rows.explain()
        assert "ExistingRDD" not in capsys.readouterr().out
    schema = T.StructType([T.StructField("place", T.ArrayType(T.LongType())), T.StructField("at", T.TimestampType())])
    assert session.no_rows(spark, schema).dtypes == [("place", "array<bigint>"), ("at", "timestamp")]


def test_nested_archives_made_in_one_step_are_those_of_two(spark):
    turns = corpus.conversation_mailboxes(spark, FOLDER)
    inner = corpus.zip_bytes(F.array(entry(F.concat("turn_id", F.lit(".mbox")), F.col("content"))))
    outer = corpus.zip_bytes(
        F.array(entry(F.lit("inner.zip"), F.col("inner")), entry(F.lit("cover.htm"), bytes_of(F.col("turn_id"))))
    )
    name = F.concat("turn_id", F.lit(".zip"))
    expected = corpus.files(turns.withColumn("inner", inner), F.lit("chat"), F.col("conv_id"), name, outer)
    made = queries._nested_files(spark, FOLDER)
    assert made.count() == expected.count() > 0
    assert made.exceptAll(expected).isEmpty()
