"""Vector operators against brute force."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from mailsift.llm import ann, embedding_dedup

KIND = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], KIND)


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 16))
    x[100:250] = x[100] + rng.normal(size=(150, 16)) * 0.12  # a crowd, chained links in it
    x[300] = x[299] * 3
    x[301] = x[299]
    return x.astype(np.float32).astype(float)


BAD = [(900, None), (901, [0.0] * 16), (902, [1.0] * 15 + [None]), (903, [float("nan")] * 16), (904, [float("inf")] + [0.0] * 15), (905, [1.0, 2.0])]


def test_links_and_components_equal_brute_force(spark, sample):
    rows = list(enumerate(sample)) + BAD + [(5, sample[5]), (None, sample[6])]
    got = embedding_dedup.near_duplicates(vectors(spark, rows).repartition(5)).collect()
    assert len(got) == len(rows)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    root = np.arange(len(sample))
    while True:
        new = np.minimum(root, np.where(linked, root[None, :], 10**9).min(1))
        if (new == root).all():
            break
        root = new
    for r in got:
        if r.vec_id is not None and r.vec_id < 400:
            assert (r.n_links, r.component_id) == (linked[r.vec_id].sum(), root[r.vec_id])
            assert r.kept == (r.vec_id == r.component_id)
        else:
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, r.vec_id is not None)


def test_tables_without_a_usable_vector(spark):
    for rows in ([], BAD):
        df = vectors(spark, rows)
        assert [r.n_links for r in embedding_dedup.near_duplicates(df).collect()] == [0] * len(rows)
        assert ann.Index(df).search(F.col("id") >= 0).count() == 0


def test_search_reaches_its_recall_and_is_exact_in_what_it_finds(spark, sample):
    rows = list(enumerate(sample)) + BAD + [(500, sample[0]), (501, sample[0])]
    x = np.concatenate([sample, sample[:1], sample[:1]])
    ids = np.array([*range(400), 500, 501])
    found = ann.Index(vectors(spark, rows)).search(F.col("id") % 10 == 0).collect()
    hits = total = 0
    for q in ids[ids % 10 == 0]:
        at = int(np.flatnonzero(ids == q)[0])
        far = np.sqrt(((x - x[at]) ** 2).sum(1))
        order = [n for n in np.lexsort((ids, far)) if n != at][:10]
        mine = sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        assert all(r.score == far[np.flatnonzero(ids == r.vec_id)[0]] for r in mine)
        hits += len({r.vec_id for r in mine} & {int(ids[n]) for n in order})
        total += 10
    assert hits >= 0.9 * total
    few = ann.Index(vectors(spark, [(0, [1, 0]), (1, [0, 1]), (2, [1, 1])])).search(F.col("id") == 0).collect()
    assert sorted((r["rank"], r.vec_id) for r in few) == [(1, 2), (2, 1)]


def test_links_do_not_depend_on_the_sizes_of_groups_and_blocks(spark, sample, monkeypatch):
    """A vector travels once for each group near its own, and links between groups are found."""
    rows = vectors(spark, list(enumerate(sample)))
    whole = sorted(embedding_dedup.near_duplicates(rows).collect())
    monkeypatch.setattr(embedding_dedup, "GROUP_BYTES", 40 * 16 * 4)  # ten groups of 40 rows
    monkeypatch.setattr(embedding_dedup, "BLOCK_BYTES", 7 * 16 * 4)
    monkeypatch.setattr(embedding_dedup, "_FEW_GROUPS", 3)
    assert sorted(embedding_dedup.near_duplicates(rows).collect()) == whole
    wide = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert sorted(embedding_dedup.near_duplicates(wide).collect()) == whole


def test_tables_of_blocks_have_small_row_groups(spark, sample, tmp_path, monkeypatch):
    """Rows of a megabyte are neither written nor read a hundred at once."""
    kept = []
    keep = embedding_dedup.Work.keep

    def seen(self, df, **options):
        kept.append(keep(self, df, **options))
        return kept[-1]

    monkeypatch.setattr(embedding_dedup.Work, "keep", seen)
    monkeypatch.setattr(embedding_dedup, "LARGE_ROWS", {**embedding_dedup.LARGE_ROWS, "parquet.block.size": "4096"})
    monkeypatch.setattr(embedding_dedup, "BLOCK_BYTES", 4 * 16 * 4)
    embedding_dedup.near_duplicates(vectors(spark, list(enumerate(sample)))).collect()
    blocks = next(df for df in kept if "vectors" in df.columns)
    files = [pq.ParquetFile(f.removeprefix("file://")) for f in blocks.inputFiles()]
    assert sum(f.metadata.num_row_groups for f in files) >= 5 * len(files)


def test_search_sends_no_table_to_the_driver_and_does_not_depend_on_sizes(spark, sample, monkeypatch):
    rows = vectors(spark, list(enumerate(sample)))
    wanted = F.col("id") % 10 == 0
    found = ann.Index(rows).search(wanted)
    plan = found._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" not in plan and "BroadcastExchange" not in plan
    whole = sorted(found.collect())
    monkeypatch.setattr(ann, "_LEAST_ROWS", 1)
    monkeypatch.setattr(ann, "SHARD_BYTES", 30 * 16 * 8)
    monkeypatch.setattr(ann, "BLOCK_BYTES", 7 * 16 * 8)
    monkeypatch.setattr(ann, "QUERY_BYTES", 9 * 16 * 8)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 2)
    index = ann.Index(rows)
    assert index.shards > 10
    assert sorted(index.search(wanted).collect()) == whole


def test_shards_without_queries_or_rows():
    eye = np.eye(3)
    asked = pa.table({"id": [1], "vector": [eye[1].tobytes()], "leaves": [np.array([0], np.int32).tobytes()]})
    held = pa.table({"leaf": [0, 5], "ids": [np.arange(3).tobytes(), np.array([9]).tobytes()], "rows": [eye.tobytes(), eye[1].tobytes()]})
    assert [(r["query_id"], r["vec_id"]) for r in ann._met(asked, held, 3, 2).to_pylist()] == [(1, 0), (1, 2)]  # leaf 5 is not asked for
    for a, h in ((asked.slice(1), held), (asked, held.slice(2)), (asked.slice(1), held.slice(2))):
        assert ann._met(a, h, 3, 2).num_rows == 0
