"""The registered queries of this package: one for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wakeline.llm import (
    cap_filters, collocations, language_id, length_buckets, license_digest, merkle, near_dedup, pii, separator_scan,
    suffix_intervals, suffix_trees, weak_supervision, winnowing,
)
from wakeline.llm.sql import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function

#: The key of the registered query; a real run takes its own from a secret store.
EXAMPLE_KEY = "an example, not a secret"


@query
def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"), EXAMPLE_KEY)


@query
def op2_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_trees.report(table(spark, sf_dir, "documents"))


@query
def op3_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_supervision.report(table(spark, sf_dir, "documents"))


@query
def op4_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest.scan(table(spark, sf_dir, "documents"))


@query
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separator_scan.token_counts(table(spark, sf_dir, "documents"))


@query
def op7_segmentation_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(table(spark, sf_dir, "documents"))


@query
def op8_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_buckets.pack(table(spark, sf_dir, "documents"))


@query
def op9_suffix_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_intervals.report(table(spark, sf_dir, "documents"))


@query
def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(table(spark, sf_dir, "documents"))


@query
def op13_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_vectors(table(spark, sf_dir, "embeddings"))


__all__ = ["ORACLES", "QUERIES"]
