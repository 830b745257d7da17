"""The corpus pipeline on small tables."""

from __future__ import annotations

import corpus_pipeline
from tests.llm.helpers import DOC, docs

LABELS = "doc_id long, quality int, toxic int"


def write(spark, folder, rows):
    docs(spark, rows).write.parquet(f"{folder}/documents.parquet")
    marks = [(i, 1, int("vile" in (t or ""))) for i, t, *_ in rows if i is not None]
    spark.createDataFrame(marks, LABELS).write.parquet(f"{folder}/labels.parquet")


def test_every_stage_does_its_work(spark, tmp_path):
    clean = [(n, " ".join(f"w{(n * 37 + k * k) % 211}" for k in range(40)), f"s{n % 3}") for n in range(60)]
    toxic = [(100 + n, clean[n][1] + " vile" * 3, "s0") for n in range(12)]
    copies = [(200 + n, clean[n][1], "s1") for n in range(5)]
    odd = [(300, None, None), (301, "", "s1"), (None, "lonely words of nobody", "s2"), (302, "x" * 3000, "s2")]
    write(spark, tmp_path, clean + toxic + copies + odd)
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(r.intact and r.n_tokens == len(r.ids) for r in rows)
    ids = {r.doc_id for r in rows}
    assert not ids & {i for i, *_ in toxic + copies}
    first = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        first = stage(spark, first, str(tmp_path))
        assert first.columns == [c.split()[0] for c in DOC.split(", ")], name


def test_an_empty_table_passes_through(spark, tmp_path):
    write(spark, tmp_path, [(1, "a", "s")])
    docs(spark, [(1, "a")]).limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
