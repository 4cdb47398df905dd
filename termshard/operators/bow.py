"""Bag of words: counts per document, vocabulary, norms, vectors.

Token tables are hash-partitioned by document once. Everything counted per document after
that, including the scores of a search, is grouped by keys that contain the document, so
it needs no further shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termshard.functions.tokens import MIN_INDEXED_LENGTH
from termshard.operators.bounds import broadcast_if_small, materialized
from termshard.operators.document_terms import gathered, with_counts

DOCUMENT = ("theme", "doc_id")
#: A task makes rows of so many tokens, some hundred bytes each, whatever the size of the data.
SHARD_TOKENS = 1_000_000
#: Between the words of a document on their way to its shard.
BREAK = "\n"


def shards_for(tokens: DataFrame) -> int:
    """Shards of about SHARD_TOKENS tokens, at least one for each core. Reads all tokens: give stored ones."""
    total = tokens.agg(F.sum(F.size("tokens").cast("bigint"))).first()[0] or 0
    return max(tokens.sparkSession.sparkContext.defaultParallelism, -(-total // SHARD_TOKENS))


def shard_by_document(tokens: DataFrame, shards: int | None = None) -> DataFrame:
    """The one exchange of a build; token arrays travel whole.

    The key is the id alone: it is what an index on disk is bucketed by, and it spreads a
    theme of any size. With a number of shards the partitions are the buckets. Without, the tokens
    are stored and counted first: partitions left to the optimizer are joined again by their packed
    size, and what a task makes of them outgrows its memory.
    """
    rows = tokens.select(*DOCUMENT, "tokens")
    if shards is None:
        rows = materialized(rows)
        shards = shards_for(rows)
    return rows.repartition(shards, "doc_id")


def _dealt(tokens: DataFrame, shards: int | None) -> DataFrame:
    """The tokens that are counted, sharded by document. They travel as one text, less than half
    the size of an array, but where a token holds the break itself."""
    rows = tokens.select(*DOCUMENT, "tokens")
    if shards is None:
        rows = materialized(rows)
        shards = shards_for(rows)
    words = F.filter("tokens", lambda t: F.length(t) >= MIN_INDEXED_LENGTH).alias("tokens")
    broken = F.exists("tokens", lambda t: t.contains(BREAK))
    packed = rows.select(*DOCUMENT, words).select(
        *DOCUMENT,
        F.when(~broken, F.array_join("tokens", BREAK)).alias("text"),
        F.when(broken, F.col("tokens")).alias("rest"),
    )
    return packed.repartition(shards, "doc_id")


def _counted(dealt: DataFrame) -> DataFrame:
    """``(theme, doc_id, term, tf)``, with a row of count 0 for what is too short or absent.

    The outer form of explode keeps Spark from deriving a filter on the array, which would
    run the analysis of the text twice.
    """
    word = F.when(F.length("term") >= MIN_INDEXED_LENGTH, F.col("term"))
    words = F.coalesce(F.split("text", BREAK), "rest")
    return (
        dealt.select(*DOCUMENT, F.explode_outer(words).alias("term"))
        .select(*DOCUMENT, word.alias("term"))
        .groupBy(*DOCUMENT, "term")
        .agg(F.count("term").alias("tf"))
    )


def term_frequencies(tokens: DataFrame, shards: int | None = None) -> DataFrame:
    """``(theme, doc_id, term, tf)``; words of one letter are not counted."""
    return _counted(_dealt(tokens, shards)).filter("term is not null")


def postings(tokens: DataFrame, shards: int | None = None) -> DataFrame:
    """``(theme, term, doc_id, tf, dl, norm_sq)``: each posting carries the length and the
    squared norm of its document, so scoring joins nothing to the document side."""
    return with_counts(_dealt(tokens, shards), BREAK, MIN_INDEXED_LENGTH)


def vocabulary(postings: DataFrame) -> DataFrame:
    """``(theme, term, df, cf)``, counted map-side before the shuffle on the term."""
    return postings.groupBy("theme", "term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("cf")
    )


def doc_stats(tokens: DataFrame) -> DataFrame:
    """``(theme, doc_id, dl, norm)`` of every document, also of those without tokens."""
    return (
        _counted(_dealt(tokens, None))
        .groupBy(*DOCUMENT)
        .agg(
            F.sum("tf").alias("dl"),
            F.sqrt(F.sum(F.col("tf") * F.col("tf")).cast("double")).alias("norm"),
        )
    )


def number_terms(vocabulary: DataFrame) -> DataFrame:
    """Add ``term_id``, the alphabetical position in the theme, without a window per theme.

    The rows are range-partitioned and sorted, written once, and numbered by their place in
    the partition plus the rows of the theme in the partitions before.
    """
    placed = materialized(
        vocabulary.repartitionByRange("theme", "term")
        .sortWithinPartitions("theme", "term")
        .withColumn("at", F.monotonically_increasing_id())
    ).withColumn("part", F.shiftright("at", 33))
    before = Window.partitionBy("theme").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # At most one row per partition and theme boundary.
    starts = (
        placed.groupBy("theme", "part")
        .agg(F.min("at").alias("first"), F.count("*").alias("rows"))
        .withColumn("offset", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        .select("theme", "part", "first", "offset")
    )
    term_id = F.col("at") - F.col("first") + F.col("offset")
    return placed.join(broadcast_if_small(starts), ["theme", "part"]).select(
        *vocabulary.columns, term_id.alias("term_id")
    )


def vectors(postings: DataFrame, numbered: DataFrame) -> DataFrame:
    """``(theme, doc_id, vector)``: per document the array of ``(term_id, tf)`` in id order."""
    from termshard.operators.skew import join_by_term

    ids = numbered.select("theme", "term", "term_id", F.col("df").alias("uses"))
    # One number per entry, in the order of (term_id, tf); a word without an id comes first.
    entry = F.shiftleft(F.coalesce("term_id", F.lit(-1).cast("bigint")), 32).bitwiseOR(F.col("tf"))
    pair = lambda e: F.struct(
        F.when(e >= 0, F.shiftright(e, 32)).alias("term_id"), e.bitwiseAND(F.lit(0xFFFFFFFF)).alias("tf")
    )
    joined = join_by_term(postings.select("theme", "term", "doc_id", "tf"), ids, ["theme", "term"])
    # Gathered before the exchange without a sort, which would spill, and in shards after it.
    total = numbered.agg(F.sum("df")).first()[0] or 0
    shards = max(postings.sparkSession.sparkContext.defaultParallelism, -(-total // SHARD_TOKENS))
    vector = F.sort_array(F.flatten(F.collect_list("entries")))
    return (
        gathered(joined.select(*DOCUMENT, entry.alias("entry")))
        .repartition(shards, "doc_id")
        .groupBy(*DOCUMENT)
        .agg(F.transform(vector, pair).alias("vector"))
    )
