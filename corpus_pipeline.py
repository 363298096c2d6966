"""The corpus pipeline: documents in, a clean, deduplicated, weighted mix out.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet and reread as the next stage's ``docs``. All stages but
the last return the columns of ``docs``.

In every stage a NULL text is an empty one, rows without a doc_id are rows like
any other (and rank last where ids are compared), repeated rows stay as many as
they are unless the stage removes copies, columns the stage does not read pass
through, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webkb.llm import decontam, mixing, quality, simhash, substrings
from webkb.llm.common import cut, read


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each group stays."""
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated 50-word passages go from all texts but the first."""
    return substrings.remove(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mixed(docs)


STAGES = [
    ("quality classifier", good),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixing_weights),
]

#: A learned classifier decides which rows go on: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each hand-over is a table in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs, f"pipeline-{i}")
    return docs
