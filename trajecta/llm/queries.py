"""Queries p5 to p8: grouped splits, corpus encoding, packing, abuse scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import cut, read_table
from . import abuse, packing, splits, tokens


def _features(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    return read_table(spark, base, "ml_iteration_features"), read_table(spark, base, "molecule_catalog")


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    features, catalogue = _features(spark, base)
    links, _ = splits.split_links(features, catalogue)
    return splits.alias_experiments(links)


def p5_splits(spark: SparkSession, base: str) -> DataFrame:
    return splits.assign_splits(*_features(spark, base))


def p6_ids(spark: SparkSession, base: str) -> DataFrame:
    return tokens.encode_corpus(read_table(spark, base, "documents"))


def p6_counts(spark: SparkSession, base: str) -> DataFrame:
    return tokens.count_tokens(read_table(spark, base, "documents"))


def standard_capacity(spark: SparkSession, base: str, window: str = "standard") -> int:
    return read_table(spark, base, "context_windows").where(F.col("window_name") == window).first()["capacity_tokens"]


def p7_packed(spark: SparkSession, base: str) -> DataFrame:
    sizes = cut(tokens.count_tokens(read_table(spark, base, "documents")), "sizes")
    return packing.pack(sizes, standard_capacity(spark, base))


def p7_containers(spark: SparkSession, base: str) -> DataFrame:
    return packing.containers(p7_packed(spark, base), standard_capacity(spark, base))


def p8_scores(spark: SparkSession, base: str) -> DataFrame:
    documents = read_table(spark, base, "documents")
    return abuse.score_documents(documents, abuse.trained(documents, read_table(spark, base, "review_labels")))


def p8_found(spark: SparkSession, base: str) -> DataFrame:
    return abuse.flagged(p8_scores(spark, base))


def p8_source_rates(spark: SparkSession, base: str) -> DataFrame:
    return abuse.source_rates(p8_scores(spark, base))


def queries() -> dict:
    return {
        "p5_found": p5_found,
        "p5_splits": p5_splits,
        "p6_ids": p6_ids,
        "p6_counts": p6_counts,
        "p7_packed": p7_packed,
        "p7_containers": p7_containers,
        "p8_found": p8_found,
        "p8_scores": p8_scores,
        "p8_source_rates": p8_source_rates,
    }


def oracle_sql() -> dict[str, str]:
    """None of these can be written in SQL; the tests hold them against brute force and exact round trips."""
    return {}
