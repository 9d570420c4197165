"""From raw documents to training batches: the stages, and a run over a data folder.

Every stage takes the documents its predecessor kept and returns the documents it keeps, with the columns of
``documents``; the last one returns their places in training batches. Between stages the documents are written to the
shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wakeline.llm import language_id, length_buckets, near_dedup, pii, winnowing
from wakeline.llm.queries import EXAMPLE_KEY
from wakeline.session import materialise


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no text, no letter, or no language that fits better than all others together."""
    return language_id.identified(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return near_dedup.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that share ten consecutive words, or a whole shorter item, with the benchmark."""
    return winnowing.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms of the same format; ``n_chars`` stays right, as lengths do not change."""
    return pii.pseudonymised(docs, EXAMPLE_KEY)


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a training batch."""
    return length_buckets.pack(docs)


STAGES = [
    ("language", known_language), ("near_dedup", one_of_each), ("decontamination", decontaminate), ("pseudonyms", pseudonymise),
    ("packing", batches),
]

#: Language scores and near-duplicate groups of a corpus go beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
