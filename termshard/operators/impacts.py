"""Impact bounds: the documents that can be among the best of a bag-of-words search.

A posting's impact is what it adds to the score for a query weight of 1. Of every word of a theme
its largest impact is stored with the index, and how many postings it has at each impact level,
sixteen a doubling. With the weights of a query they bound from above what a word can add, and
from below what the n-th best document scores. Then

1. the weakest words of a query, as long as all they can add together is below that n-th best, are
   set aside: a document with none of the other words can't be among the best;
2. only the postings of the other words are joined to the queries and summed; the n-th largest
   such sum is a better lower bound, and documents that stay below it whatever the words set
   aside add are dropped;
3. what remains is scored in full.

No document of the best n is lost: sums and bounds are compared with a margin for rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termshard.operators.bounds import broadcast_if_small, fits_broadcast, materialized
from termshard.operators.ranking import top_n
from termshard.operators.skew import join_postings

PER_DOUBLING = 16
MARGIN = 1e-8
#: Pruning is considered for batches of so many query words, and done where it halves the rows.
BATCH_WORDS = 10_000
WORTH = 0.5


def _reaches(value: Column, bound: Column) -> Column:
    """Scores are compared by their rounded values: the margin is wider than that."""
    return value >= bound - (bound + 1) * MARGIN


def impact_levels(postings: DataFrame, impact: Column) -> DataFrame:
    """``(theme, term, level, n, most)``: the postings of a word at each level of impact, and the
    largest of them."""
    return (
        postings.select("theme", "term", impact.alias("impact"))
        .filter("impact > 0")
        .groupBy("theme", "term", F.floor(F.log2("impact") * PER_DOUBLING).cast("int").alias("level"))
        .agg(F.count("*").alias("n"), F.max("impact").alias("most"))
    )


def bounded(weights: DataFrame, levels: DataFrame, n: int, small: bool) -> DataFrame:
    """``weights`` (query_id, theme, term, weight) with ``strong``, whether the word is needed, ``rest``,
    what the words set aside can add together, ``least``, what the n-th best scores at least, and
    ``rows``, the postings of the word. Weights are not negative."""
    keys = ["theme", "term"]
    asked = weights.select(*keys).distinct()
    levels = levels.join(F.broadcast(asked) if small else asked, keys)
    above = Window.partitionBy(*keys).orderBy(F.desc("level"))
    counted = levels.withColumn("above", F.sum("n").over(above))
    nth = F.max(F.when(F.col("above") >= n, F.pow(F.lit(2.0), F.col("level") / PER_DOUBLING)))
    per_word = counted.groupBy(*keys).agg(
        F.max("most").alias("most"), F.coalesce(nth, F.lit(0.0)).alias("nth"), F.sum("n").alias("rows")
    )
    joined = weights.join(F.broadcast(per_word) if small else per_word, keys)
    joined = joined.withColumn("adds", F.col("weight") * F.col("most"))
    query = Window.partitionBy("query_id", "theme")
    weakest = query.orderBy("adds", "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = joined.withColumn("least", F.max(F.col("weight") * F.col("nth")).over(query))
    joined = joined.withColumn("strong", _reaches(F.sum("adds").over(weakest), F.col("least")))
    rest = F.sum(F.when(F.col("strong"), F.lit(0.0)).otherwise(F.col("adds"))).over(query)
    return joined.select("query_id", *keys, "weight", "strong", rest.alias("rest"), "least", "rows")


def is_worth_it(bounds: DataFrame) -> bool:
    """Whether the words that are needed have at most WORTH of the postings."""
    strong = F.sum(F.when(F.col("strong"), F.col("rows")).otherwise(0))
    row = bounds.agg(F.sum("rows").alias("all"), strong.alias("strong")).first()
    return row["all"] is not None and row["strong"] <= WORTH * row["all"]


def candidates(
    postings: DataFrame, impact: Column, bounds: DataFrame, vocabulary: DataFrame, n: int, small: bool,
    limit: int | None = None,
) -> DataFrame:
    """``(query_id, theme, doc_id)``, stored: every document that can be among the best ``n`` of a query
    in its theme."""
    rows = postings.select("theme", "term", "doc_id", impact.alias("impact"))
    strong = bounds.filter("strong").select("query_id", "theme", "term", "weight", "rest", "least")
    partial = (
        join_postings(rows, strong, vocabulary, small, limit)
        .groupBy("query_id", "theme", "doc_id")
        .agg(
            F.sum(F.col("weight") * F.col("impact")).alias("sum"),
            F.max("rest").alias("rest"),
            F.max("least").alias("least"),
        )
    )
    can = F.col("sum") + F.col("rest")
    partial = materialized(partial.filter(_reaches(can, F.col("least"))))
    nth = top_n(partial, n, ["query_id", "theme"], [F.desc("sum"), F.col("doc_id")]).filter(F.col("rank") == n)
    nth = broadcast_if_small(nth.select("query_id", "theme", F.col("sum").alias("nth")))
    enough = _reaches(can, F.coalesce("nth", F.lit(0.0)))
    return materialized(
        partial.join(nth, ["query_id", "theme"], "left").filter(enough).select("query_id", "theme", "doc_id")
    )


def only_documents(postings: DataFrame, found: DataFrame) -> DataFrame | None:
    """The postings of the documents among ``found``; nothing if these are beyond a broadcast."""
    documents = found.select("theme", "doc_id").distinct()
    if not fits_broadcast(documents):
        return None
    return postings.join(F.broadcast(documents), ["theme", "doc_id"], "left_semi")


def only_found(scored: DataFrame, found: DataFrame) -> DataFrame:
    return scored.join(broadcast_if_small(found), ["query_id", "theme", "doc_id"], "left_semi")
