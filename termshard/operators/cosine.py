"""Ranked search by cosine similarity of raw term counts, for tables of queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termshard.functions.display import document_key, preview, shown_score
from termshard.functions.tokens import MIN_INDEXED_LENGTH
from termshard.operators import blocks, bow, impacts
from termshard.operators.bounds import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    broadcast_if_small,
    counted_values,
    fits_broadcast,
    measured_size,
    listed,
    materialized,
    one_of,
)
from termshard.operators.ranking import COSINE_DIGITS, by_score, checked_count, top_n
from termshard.operators.skew import join_postings

DEFAULT_RESULTS = 5


@dataclass(frozen=True)
class BowIndex:
    """Postings and vocabulary. ``themes`` lists the corpora, with ``ordinal`` if they have
    an order; otherwise equal scores are ordered by theme name. ``levels`` are the impact levels of
    the words, if they are stored. ``stored`` are the postings as they lie on disk, if ``postings``
    deals them out by document."""

    postings: DataFrame
    vocabulary: DataFrame
    themes: DataFrame
    levels: DataFrame | None = None
    stored: DataFrame | None = None

    def only(self, theme: str) -> BowIndex:
        here = F.col("theme") == theme
        return BowIndex(
            self.postings.filter(here),
            self.vocabulary.filter(here),
            self.themes.filter(here),
            None if self.levels is None else self.levels.filter(here),
            None if self.stored is None else self.stored.filter(here),
        )


def cosine_impact() -> Column:
    return F.col("tf") / F.sqrt(F.col("norm_sq").cast("double"))


def cosine_levels(postings: DataFrame) -> DataFrame:
    return impacts.impact_levels(postings, cosine_impact())


def bow_index(tokens: DataFrame, themes: DataFrame | None = None) -> BowIndex:
    """Postings and vocabulary are stored, as every step of a search reads them again."""
    tokens = materialized(tokens.select(*bow.DOCUMENT, "tokens"))
    shards = bow.shards_for(tokens)
    stored = materialized(bow.postings(tokens, shards))
    if themes is None:
        themes = tokens.select("theme").distinct()
    dealt = stored.repartition(shards, "doc_id")
    return BowIndex(dealt, materialized(bow.vocabulary(stored)), themes, stored=stored)


def query_terms(queries: DataFrame) -> DataFrame:
    """``(query_id, term, qtf)`` of analysed queries ``(query_id, tokens)``."""
    return (
        queries.select("query_id", F.explode_outer("tokens").alias("term"))
        .filter(F.length("term") >= MIN_INDEXED_LENGTH)
        .groupBy("query_id", "term")
        .agg(F.count("*").alias("qtf"))
    )


def query_weights(terms: DataFrame, vocabulary: DataFrame, small: bool = False) -> DataFrame:
    """``(query_id, theme, term, qtf, q_norm_sq)``: per theme only the words it knows, and
    the norm over those alone."""
    side = F.broadcast(terms) if small else terms
    known = vocabulary.select("theme", "term").join(side, "term")
    query = Window.partitionBy("query_id", "theme")
    return known.select(
        "query_id",
        "theme",
        "term",
        "qtf",
        F.sum(F.col("qtf") * F.col("qtf")).over(query).alias("q_norm_sq"),
    )


def scores(
    terms: DataFrame,
    index: BowIndex,
    limit: int | None = None,
    small: bool | None = None,
    best: int | None = None,
    prune: bool | None = None,
    each: bool = True,
) -> DataFrame:
    """``(query_id, theme, doc_id, similarity_score)`` of every document that shares a word.
    ``small``: whether the query side may be broadcast; it is measured if not given.

    With ``best`` only the documents that can be among that many of a query and theme, or without
    ``each`` of a query, need be given. ``prune``: whether to find these by impact bounds first. If it
    is not given, a large batch and one that may not be broadcast are scored cell by cell.
    """
    rows, words = counted_values(terms, "term")
    if best is not None and prune is None and (rows >= impacts.BATCH_WORDS or small is False):
        postings = index.postings if index.stored is None else index.stored
        return blocks.best_cosines(postings, terms, index.vocabulary, best, each)
    if small is None:
        size = measured_size(terms)[1] if words is None else 0  # listed words are few
        themes = max(index.themes.count(), 1)
        small = rows * themes <= BROADCAST_ROWS and size * themes <= BROADCAST_BYTES
    postings, vocabulary = index.postings, index.vocabulary
    if words is not None:
        postings = postings.filter(one_of("term", words))
        vocabulary = vocabulary.filter(one_of("term", words))
    weights = query_weights(terms, vocabulary, small)
    found = None
    if best is not None and prune:
        levels = cosine_levels(postings) if index.levels is None else index.levels
        weight = (F.col("qtf") / F.sqrt(F.col("q_norm_sq").cast("double"))).alias("weight")
        weighted = weights.select("query_id", "theme", "term", weight)
        bounds = materialized(impacts.bounded(weighted, levels, best, small))
        found = impacts.candidates(postings, cosine_impact(), bounds, vocabulary, best, small, limit)
        fewer = impacts.only_documents(postings, found)
        postings, found = (postings, None) if fewer is None else (fewer, found)
    needed = postings.select("theme", "term", "doc_id", "tf", "norm_sq")
    dots = (
        join_postings(needed, weights, vocabulary, small, limit)
        .groupBy("query_id", "theme", "doc_id")
        .agg(
            F.sum(F.col("tf") * F.col("qtf")).alias("dot"),
            F.max("norm_sq").alias("norm_sq"),
            F.max("q_norm_sq").alias("q_norm_sq"),
        )
    )
    if found is not None:
        dots = impacts.only_found(dots, found)
    norms = F.sqrt(F.col("norm_sq").cast("double") * F.col("q_norm_sq").cast("double"))
    return dots.select(
        "query_id", "theme", "doc_id", (F.col("dot") / norms).alias("similarity_score")
    ).filter("similarity_score > 0")


def search_each(
    queries: DataFrame,
    index: BowIndex,
    n: int = DEFAULT_RESULTS,
    small: bool | None = None,
    prune: bool | None = None,
) -> DataFrame:
    """The best ``n`` documents of every theme for every query."""
    checked_count(n)
    scored = scores(query_terms(queries), index, small=small, best=n, prune=prune)
    order = [by_score("similarity_score", COSINE_DIGITS), F.col("doc_id")]
    return top_n(scored, n, ["query_id", "theme"], order, rank="theme_rank")


def search_theme(
    queries: DataFrame, index: BowIndex, theme: str, n: int = DEFAULT_RESULTS
) -> DataFrame:
    """One theme; an unknown theme gives no rows."""
    return search_each(queries, index.only(theme), n)


def search_all(
    queries: DataFrame, index: BowIndex, n: int = DEFAULT_RESULTS, prune: bool | None = None
) -> DataFrame:
    """The best ``n`` documents over all themes, with their rank overall and in the theme.

    Equal scores keep the order of the themes, then of the documents. The hits of a theme
    are its best ones, so their rank among the hits is their rank in the theme.
    """
    checked_count(n)
    scored = scores(query_terms(queries), index, best=n, prune=prune, each=False)
    theme_order = [F.col("theme"), F.col("doc_id")]
    if "ordinal" in index.themes.columns:
        ordinals = broadcast_if_small(index.themes.select("theme", "ordinal"))
        scored = scored.join(ordinals, "theme")
        theme_order = [F.col("ordinal"), F.col("doc_id")]
    hits = top_n(scored, n, ["query_id"], [by_score("similarity_score", COSINE_DIGITS), *theme_order])
    in_theme = Window.partitionBy("query_id", "theme").orderBy("rank")
    return hits.withColumn("theme_rank", F.row_number().over(in_theme)).select(
        "query_id", "theme", "doc_id", "similarity_score", "theme_rank", "rank"
    )


def with_content(hits: DataFrame, tokens: DataFrame) -> DataFrame:
    """Add the tokens of each hit as ``content``, null where the document is gone.

    The hits are stored first. A short list of ids prunes the buckets of a stored token table,
    and the keys of the hits, if they fit a broadcast, leave only their documents to the join.
    """
    hits = materialized(hits)
    document = list(bow.DOCUMENT)
    content = tokens.select(*document, F.col("tokens").alias("content"))
    ids = listed(hits, "doc_id")
    if ids is not None:
        content = content.filter(one_of("doc_id", ids, ranges=False))
    keys = hits.select(*document).distinct()
    if fits_broadcast(keys):
        content = content.join(F.broadcast(keys), document, "left_semi")
    return hits.join(content, document, "left")


def listing(hits_with_content: DataFrame, rank: str = "rank") -> DataFrame:
    """What a reader sees: rank, place, rounded score and the start of the content."""
    return hits_with_content.select(
        "query_id",
        rank,
        "theme",
        "doc_id",
        document_key(F.col("theme"), F.col("doc_id")).alias("document"),
        shown_score(F.col("similarity_score")).alias("score"),
        preview(F.col("content")).alias("preview"),
    )


def result_counts(hits: DataFrame) -> DataFrame:
    return hits.groupBy("query_id").agg(F.count("*").alias("n_results"))
