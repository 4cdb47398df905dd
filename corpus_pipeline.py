"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termshard.llm.common import materialized, table
from termshard.llm.content_sort import drop_copies
from termshard.llm.minhash import drop_near_duplicates
from termshard.llm.mixing import mixed_documents
from termshard.llm.packing import pack_documents
from termshard.llm.risk_rules import keep_quality


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8 or more: one document of each component stays."""
    return drop_near_duplicates(docs, width=5, percent=80)


def temperature_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; small sources are repeated up to 1.5 times."""
    return mixed_documents(docs, repetitions=1.5)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the sequences, with their ids, and gives the pieces that are read from them."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("temperature mixing", temperature_mixing),
    ("best-fit packing", best_fit_packing),
]

#: Similarity, bisection and packing are not expressible in SQL; tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
