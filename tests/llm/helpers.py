"""Small tables for the operators' tests."""

from __future__ import annotations

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, source)."""
    full = []
    for row in rows:
        doc_id, text, source = (*row, "s")[:3]
        full.append((doc_id, text, "en", source, None if text is None else len(text)))
    return spark.createDataFrame(full, DOC)


def clashing(df):
    """The table with extra columns under names that operators use themselves."""
    from pyspark.sql import functions as F

    for name in ("row", "id", "key", "size", "hash", "score", "ids", "kept", "chunk", "slot", "host", "_listed"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(f"own {name}"))
    return df
