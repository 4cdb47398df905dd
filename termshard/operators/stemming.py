"""Stemming as a table: each distinct word once, then a join back to the tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termshard.operators.bounds import fits_broadcast
from termshard.operators.skew import join_by_term
from termshard.operators.stem_english import english_stem, looks_english
from termshard.operators.stem_indonesian import with_indonesian_stem

STEMMERS = ("indonesian", "hybrid")


def distinct_terms(tokens: DataFrame, column: str = "tokens") -> DataFrame:
    """``(term, uses)`` over all token arrays, counted map-side first.

    The outer form of explode: the plain one adds a filter on the size of the array, which
    would compute the array a second time.
    """
    return (
        tokens.select(F.explode_outer(column).alias("term"))
        .filter("term is not null")
        .groupBy("term")
        .agg(F.count("*").alias("uses"))
    )


def stem_map(
    terms: DataFrame, roots: DataFrame, stemmer: str = "indonesian", roots_fit: bool | None = None
) -> DataFrame:
    """``(term, stem, uses)``.

    ``hybrid`` takes the Indonesian stem where it differs from the word, else the English one
    for words with an English ending, else the word. A word costs far more time than bytes,
    so the words are spread by a fixed number of partitions, not by their size.
    """
    if stemmer not in STEMMERS:
        raise ValueError(f"unknown stemmer {stemmer!r}; known: {STEMMERS}")
    if roots_fit is None:
        roots_fit = fits_broadcast(roots)
    partitions = int(terms.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = terms.repartition(partitions, "term")
    stemmed = with_indonesian_stem(spread, roots, roots_fit)
    stem = F.col("id_stem")
    if stemmer == "hybrid":
        stem = (
            F.when(F.col("id_stem") != F.col("term"), F.col("id_stem"))
            .when(looks_english(F.col("term")), english_stem("term"))
            .otherwise(F.col("term"))
        )
    return stemmed.select("term", stem.alias("stem"), "uses")


def stem_rows(rows: DataFrame, stems: DataFrame, document: tuple[str, ...]) -> DataFrame:
    """Add ``stem`` to rows with a ``term``; a word missing from the map stays itself."""
    joined = join_by_term(rows, stems, ["term"], document)
    return joined.withColumn("stem", F.coalesce("stem", "term"))
