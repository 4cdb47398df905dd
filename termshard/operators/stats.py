"""Corpus statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def documents_per_theme(tokens: DataFrame, themes: DataFrame | None = None) -> DataFrame:
    """``(theme, n_docs)``, with ``ordinal`` and in registry order if there is a registry."""
    counts = tokens.groupBy("theme").agg(F.count("*").alias("n_docs"))
    if themes is None:
        return counts
    return themes.join(counts, "theme").orderBy("ordinal")


def corpus_totals(tokens: DataFrame) -> DataFrame:
    """Documents per theme and, in the row without a theme, over all of them."""
    totals = tokens.rollup("theme").agg(
        F.count("*").alias("n_docs"), F.grouping("theme").alias("is_total")
    )
    return totals.select("theme", "n_docs", "is_total")


def loaded_themes(tokens: DataFrame) -> DataFrame:
    per_theme = tokens.groupBy("theme").agg(F.count("*").alias("n"))
    return per_theme.agg(
        F.count("*").alias("n_themes"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_docs")
    )
