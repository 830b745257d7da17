"""Every query against its SQL twin in DuckDB, on whole tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("MAILSIFT_TEST_DATA", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    ours = contract.queries()[name](spark, FOLDER)
    got = rows_of(ours.columns, [tuple(r) for r in ours.collect()])
    sql = duck.sql(contract.oracle_sql()[name])
    want = rows_of(sql.columns, sql.fetchall())
    assert got[0] == want[0]
    assert sum(want[1].values()) > 0
    missing, extra = want[1] - got[1], got[1] - want[1]
    assert not missing and not extra, (list(missing)[:3], list(extra)[:3])
