"""Documents made ready for training, stage by stage; each stage calls one operator of ``cambist.llm``.

Toxic documents go, one document of each group of near copies stays, repeated passages
are cut out of texts, documents that hold benchmark items go, and what is left is packed
into sequences. Each stage is written as Parquet and read again by the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cambist.llm import decontamination, near_duplicates, packing, repeats, toxicity
from cambist.llm.shared import saved, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near copies: runs of five words, similarity of 0.8 or more.
SHINGLE_WORDS, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents graded at least 1 by the severity model, learned from this stage's documents and ``labels``, go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays."""
    return near_duplicates.one_of_each(docs, SHINGLE_WORDS, PERCENT)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that stand in two places are cut out; documents stay."""
    return repeats.without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item is found go."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's ids, cut and packed into sequences; returns pieces."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("substring_repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: SQL cannot express the first and last stage; tests hold the first against labels it was not trained on, the others
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
