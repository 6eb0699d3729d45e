"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes the rows that the one before it kept, as written to the shared folder, and returns the rows it
keeps, with all columns; the last returns the packed pieces. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layerhouse.llm import decontaminate, language, packing, quality, simhash
from layerhouse.llm.common import ready, saved, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the weak-label classifier, fitted on these documents, does not reject."""
    ready(spark)
    return quality.keep(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what has a language that can be told, by a model learned from these documents."""
    ready(spark)
    return language.keep(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: that of the smallest doc_id."""
    ready(spark)
    return simhash.deduplicate(docs, shingle=3, distance=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more lies in benchmark passages."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), size=13)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 1024 tokens."""
    ready(spark)
    return packing.pack(docs, size=1024, end=2)


STAGES = [
    ("quality classifier", quality_classifier),
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: The classifiers are trained and the ids are a tokenizer's: not expressible in SQL, tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"stage{number}-{name.replace(' ', '-')}")
    return docs
