"""The hash tree against a plain computation."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from mailsift.llm import merkle
from mailsift.llm import queries as catalog
from tests.llm.helpers import DOC, clashing


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    return sha(*[field(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)])


def climb(nodes, fanout):
    """The root of a list of nodes, and for each the (left, right) siblings on its way up."""
    proofs, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        parents, merged = [], []
        for k in range(0, len(nodes), fanout):
            run = nodes[k : k + fanout]
            for j in range(len(run)):
                for i in groups[k + j]:
                    proofs[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            parents.append(sha(*run))
            merged.append([i for g in groups[k : k + fanout] for i in g])
        nodes, groups = parents, merged
    return nodes[0], proofs


def plain(rows, fanout=3):
    """(doc_id, leaf, subroot, root, proof) of every row."""
    by = defaultdict(list)
    for row in rows:
        by[row["source"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf_of(row, row["text"]), row))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs, out = [], []
    for source in order:
        nodes = sorted(by[source], key=lambda x: x[:3])
        root, proofs = climb([n[2] for n in nodes], fanout)
        subs.append((root, [(n[3], n[2], p) for n, p in zip(nodes, proofs)]))
    root, tops = climb([s for s, _ in subs], fanout)
    for (sub, nodes), top in zip(subs, tops):
        out += [(row, leaf, sub, root, proof + top) for row, leaf, proof in nodes]
    return out


def fold(node, proof):
    for left, right in proof:
        node = sha(left, node, right)
    return node


def rows_of(sizes, seed=3):
    rng, rows, n = random.Random(seed), [], 0
    for source, size in sizes.items():
        for _ in range(size):
            text = rng.choice([None, "", "a\nb\n", "ü\n" * 3, "x" * 5000, "plain"])
            rows.append((n, text, rng.choice(["en", None, ""]), source, None if text is None else len(text)))
            n += rng.randint(1, 4)
    return rows


SIZES = {"big": 100, "lone": 1, None: 4, "": 3, "é": 9, "Z": 10, "z": 2}


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_tree_equals_a_plain_computation(spark, fanout):
    rows = rows_of(SIZES)
    rows += [rows[7], rows[7], (None, "t", "en", "big", 1), (None, None, None, None, None), (5, "other", "en", "big", 5)]
    df = clashing(spark.createDataFrame(rows, DOC)).repartition(7)
    manifest = merkle.Manifest(df, fanout=fanout)
    got = sorted((str(r.key), r.leaf, r.subroot, r.root, [tuple(s) for s in r.proof]) for r in manifest.proofs().collect())
    names = DOC.replace(" long", "").replace(" string", "").split(", ")
    want = plain([dict(zip(names, r)) for r in rows], fanout)
    assert got == sorted((str(row["doc_id"]), *rest) for row, *rest in want)
    assert {r.grp: r.subroot for r in manifest.subroots().collect()} == {row["source"]: sub for row, _, sub, _, _ in want}


def test_query_marks_what_was_tampered_with(spark, tmp_path):
    rows = rows_of(SIZES, 8)
    spark.createDataFrame(rows, DOC).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in catalog.op13_merkle(spark, str(tmp_path)).collect()}
    names = DOC.replace(" long", "").replace(" string", "").split(", ")
    assert len(got) == len(rows)
    for row, leaf, sub, root, proof in plain([dict(zip(names, r)) for r in rows]):
        text = row["text"]
        if zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0 and text is not None:
            text = text.replace("\n", "")
        folded = fold(leaf_of(row, text), proof)
        r = got[row["doc_id"]]
        assert (r.leaf, r.subroot, r.root, r.folded_root, r.verified) == (leaf, sub, root, folded, folded == root)
        assert r.proof_sha256 == sha(*[a + b for a, b in proof])
    assert {r.verified for r in got.values()} == {True, False}


def test_small_and_empty_tables(spark):
    empty = spark.createDataFrame([], DOC)
    manifest = merkle.Manifest(empty)
    assert manifest.root is None and manifest.proofs().count() == 0 and manifest.subroots().count() == 0
    one = spark.createDataFrame([(1, "t", "en", "s", 1)], DOC)
    manifest = merkle.Manifest(one)
    row = manifest.verify(manifest.proofs()).first()
    assert row.leaf == row.subroot == row.root == manifest.root and row.proof == [] and row.verified
    with pytest.raises(ValueError):
        merkle.Manifest(one, fanout=1)


def test_any_change_of_any_field_is_seen(spark):
    rows = rows_of({"a": 11, "b": 5})
    before = merkle.Manifest(spark.createDataFrame(rows, DOC)).root
    for change in ({"lang": "xx"}, {"n_chars": 77}, {"source": "a"}, {"text": "10:0"}):
        df = spark.createDataFrame(rows, DOC)
        for name, value in change.items():
            df = df.withColumn(name, F.when(F.col("doc_id") == rows[-1][0], F.lit(value)).otherwise(F.col(name)))
        assert merkle.Manifest(df).root != before
