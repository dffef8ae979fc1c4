from __future__ import annotations

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text) as a documents table, with extra columns whose names operators use inside."""

    def build(rows):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        frame = spark.createDataFrame(full, DOCS)
        for name in ("n_words", "n_shingles", "component_id", "kept", "text_hash", "cid", "k1", "row", "node", "size", "start", "toxic", "place", "_id", "_hash", "_kept", "_text_hash", "_row", "_task", "_base", "_label", "document", "of", "found", "text_key", "rank", "buckets", "_document", "sequence_id"):
            frame = frame.withColumn(name, F.lit("x"))
        return frame

    return build
