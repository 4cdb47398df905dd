"""Indexes on disk.

Postings are partitioned by theme, bucketed by document and sorted by term. A search then
reads the partitions of its themes, skips the row groups without its terms, and groups by
document without a shuffle, since Spark takes the buckets as the partitioning.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termshard.operators.bounds import materialized
from termshard.operators.bow import DOCUMENT, postings, shard_by_document, vocabulary
from termshard.operators.cosine import BowIndex, cosine_levels
from termshard.operators.fulltext import (
    TextIndex,
    bm25_levels,
    corpus_stats,
    text_doc_stats,
    text_postings,
)
from termshard.operators.patterns import backward_terms, term_grams

#: The task of a bucket makes rows of all its tokens, at the build and for a batch of queries.
TOKENS_PER_BUCKET = 2_000_000
LEAST_BUCKETS = 8


def buckets_for(tokens: DataFrame) -> int:
    """Buckets so that one holds about TOKENS_PER_BUCKET tokens, whatever the size of the data."""
    total = tokens.agg(F.sum(F.size("tokens").cast("bigint"))).first()[0] or 0
    return max(LEAST_BUCKETS, -(-total // TOKENS_PER_BUCKET))


def _table_name(path: str, part: str) -> str:
    return f"termshard_{hashlib.sha256(path.encode()).hexdigest()[:16]}_{part}"


def _write_bucketed(
    df: DataFrame, path: str, part: str, buckets: int, sort_by: list[str]
) -> None:
    """``df`` comes hash-partitioned by document into ``buckets`` partitions, so each task
    holds one bucket and writes one file per theme."""
    spark = df.sparkSession
    name = _table_name(path, part)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (
        df.write.partitionBy("theme")
        .bucketBy(buckets, "doc_id")
        .sortBy(*sort_by)
        .option("path", f"{path}/{part}")
        .format("parquet")
        .saveAsTable(name)
    )


def _write_info(spark: SparkSession, path: str, buckets: int) -> None:
    spark.createDataFrame([(buckets,)], "buckets int").write.parquet(f"{path}/info")


def _open_bucketed(spark: SparkSession, path: str, part: str, sort_by: list[str]) -> DataFrame:
    """The bucketed table; registered here if another session wrote it."""
    name = _table_name(path, part)
    if not spark.catalog.tableExists(name):
        buckets = spark.read.parquet(f"{path}/info").first()["buckets"]
        schema = spark.read.parquet(f"{path}/{part}").schema
        columns = ", ".join(
            f"{f.name} {'string' if f.name == 'theme' else f.dataType.simpleString()}"
            for f in schema
        )
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (theme) "
            f"CLUSTERED BY (doc_id) SORTED BY ({', '.join(sort_by)}) INTO {buckets} BUCKETS "
            f"LOCATION '{path}/{part}'"
        )
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def build_bow_index(
    tokens: DataFrame, path: str, buckets: int | None = None, themes: DataFrame | None = None
) -> BowIndex:
    """Count the tokens, write the index to an empty folder and give it back as read.

    The tokens are stored first, as several steps read them. One exchange of token arrays: counting,
    sorting and writing happen in the same tasks.
    """
    spark = tokens.sparkSession
    tokens = materialized(tokens.select(*DOCUMENT, "tokens"))
    buckets = buckets or buckets_for(tokens)
    _write_info(spark, path, buckets)
    _write_bucketed(postings(tokens, buckets), path, "postings", buckets, ["term"])
    stored = _open_bucketed(spark, path, "postings", ["term"])
    _write_by_term(vocabulary(stored), f"{path}/vocabulary")
    _write_by_term(cosine_levels(stored), f"{path}/levels")
    if themes is None:
        themes = tokens.select("theme").distinct()
    if "ordinal" not in themes.columns:
        themes = themes.withColumn("ordinal", F.lit(None).cast("int"))
    themes.select("theme", "ordinal").write.parquet(f"{path}/themes")
    return open_bow_index(spark, path)


def open_bow_index(spark: SparkSession, path: str) -> BowIndex:
    themes = spark.read.parquet(f"{path}/themes")
    if themes.filter("ordinal is null").limit(1).count():
        themes = themes.drop("ordinal")
    return BowIndex(
        _open_bucketed(spark, path, "postings", ["term"]),
        spark.read.parquet(f"{path}/vocabulary"),
        themes,
        spark.read.parquet(f"{path}/levels"),
    )


def build_text_index(
    tokens: DataFrame, path: str, buckets: int | None = None
) -> TextIndex:
    spark = tokens.sparkSession
    tokens = materialized(tokens.select(*DOCUMENT, "tokens"))
    buckets = buckets or buckets_for(tokens)
    _write_info(spark, path, buckets)
    _write_bucketed(text_postings(tokens, buckets), path, "postings", buckets, ["term"])
    stored = _open_bucketed(spark, path, "postings", ["term"])
    counts = stored.groupBy("theme", "term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("cf")
    )
    _write_by_term(counts, f"{path}/vocabulary")
    terms = spark.read.parquet(f"{path}/vocabulary")
    _write_by_term(backward_terms(terms), f"{path}/backward", "backward")
    _write_by_term(term_grams(terms), f"{path}/grams", "gram")
    stats = text_doc_stats(tokens).repartition(buckets, "doc_id")
    _write_bucketed(stats, path, "doc_stats", buckets, ["doc_id"])
    corpus_stats(_open_bucketed(spark, path, "doc_stats", ["doc_id"])).write.parquet(
        f"{path}/corpus_stats"
    )
    levels = bm25_levels(stored, spark.read.parquet(f"{path}/corpus_stats"))
    _write_by_term(levels, f"{path}/levels")
    return open_text_index(spark, path)


def open_text_index(spark: SparkSession, path: str) -> TextIndex:
    return TextIndex(
        _open_bucketed(spark, path, "postings", ["term"]),
        spark.read.parquet(f"{path}/vocabulary"),
        _open_bucketed(spark, path, "doc_stats", ["doc_id"]),
        spark.read.parquet(f"{path}/corpus_stats"),
        spark.read.parquet(f"{path}/backward"),
        spark.read.parquet(f"{path}/grams"),
        spark.read.parquet(f"{path}/levels"),
    )


def save_tokens(tokens: DataFrame, path: str, buckets: int | None = None) -> DataFrame:
    """Token arrays bucketed by document, so that a few documents are fetched by bucket."""
    if buckets is None:
        tokens = materialized(tokens.select(*DOCUMENT, "tokens"))
        buckets = buckets_for(tokens)
    _write_info(tokens.sparkSession, path, buckets)
    sharded = shard_by_document(tokens, buckets)
    _write_bucketed(sharded, path, "tokens", buckets, ["doc_id"])
    return open_tokens(tokens.sparkSession, path)


def open_tokens(spark: SparkSession, path: str) -> DataFrame:
    return _open_bucketed(spark, path, "tokens", ["doc_id"])


def _write_by_term(rows: DataFrame, path: str, term: str = "term") -> None:
    """Range-partitioned by term: a look-up of a few terms opens a few files."""
    rows.repartitionByRange(term).sortWithinPartitions(term).write.parquet(path)


def searchable_themes(index: BowIndex | TextIndex) -> list[str]:
    """The themes that have terms; a theme of empty documents cannot be searched. One name per
    corpus comes back."""
    return sorted(r["theme"] for r in index.vocabulary.select("theme").distinct().collect())
