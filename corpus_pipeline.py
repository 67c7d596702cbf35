"""Corpus pipeline: five stages from `documents` to a mix of sources.

toxicity -> quality -> near duplicates -> benchmark decontamination -> mixing.
Each stage works on all rows that its predecessor kept; all but the last return the
columns of `documents`. Near duplicates share at least 0.8 of their five-word
shingles; one document of each component stays.

No stage can be said in SQL as a whole (learned models, sketches, alignment, seeded
selection), so ORACLE_SQL is None; `tests/llm` holds each operator against a
brute-force version or held-out accuracy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import read, scratch, stored
from tessera.llm.decontaminate import decontaminated
from tessera.llm.mixing import mixed_documents
from tessera.llm.parity import deduplicated
from tessera.llm.quality import good_documents
from tessera.llm.toxicity import harmless_documents


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return harmless_documents(docs, read(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicated(docs, percent=80, width=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    folder = scratch(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
