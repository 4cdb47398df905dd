"""Analysis profiles: how the text of a corpus, or of a query, becomes tokens."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termshard.functions.normalize import normalize, query_letters, squeeze
from termshard.functions.tokens import HEADER_WORDS, drop_words, is_noise, split_words
from termshard.operators.bounds import broadcast_if_small, fits_broadcast, listed, materialized
from termshard.operators.bow import DOCUMENT, shards_for
from termshard.operators.document_terms import replaced
from termshard.operators.stemming import distinct_terms, stem_map, stem_rows


@dataclass(frozen=True)
class Profile:
    """``noise_first`` filters noise before stemming and leaves the stems alone; otherwise
    noise and stop words are filtered from the stems."""

    name: str
    form: str
    stemmer: str
    noise_first: bool
    extra_words: tuple[str, ...] = ()


THESIS = Profile("thesis", "quoted", "indonesian", noise_first=True)
HEADED_THESIS = Profile("headed", "headed", "indonesian", noise_first=True, extra_words=HEADER_WORDS)
NEWS = Profile("news", "plain", "hybrid", noise_first=False)
ESSAY = Profile("essay", "reduplicated", "hybrid", noise_first=False)

def words_of(text: Column, profile: Profile) -> Column:
    return split_words(normalize(text, profile.form))


# A stop list: words, or a table of any size with a column ``term``.
StopWords = DataFrame | Iterable[str]


def _short_list(stop: StopWords) -> list[str] | None:
    return listed(stop, "term") if isinstance(stop, DataFrame) else sorted(set(stop))


def _in_list(rows: DataFrame, column: str, stop: StopWords) -> DataFrame:
    """Flag rows whose word is listed: by a literal set if the list is short, else by a join."""
    words = _short_list(stop)
    if words is not None:
        flag = F.col(column).isin(words) if words else F.lit(False)
        return rows.withColumn("is_listed", flag)
    marks = stop.select(F.col("term").alias(column), F.lit(True).alias("is_listed")).distinct()
    marked = rows.join(broadcast_if_small(marks), column, "left")
    return marked.withColumn("is_listed", F.coalesce("is_listed", F.lit(False)))


def term_table(
    terms: DataFrame, profile: Profile, stop: StopWords, roots: DataFrame
) -> DataFrame:
    """``(term, stem, uses)``: what the profile makes of each distinct word, null if it drops it.

    All its filters look at one word only, so they run once per word and not once per token.
    """
    marked = _in_list(terms, "term", stop)
    dropped = F.col("is_listed")
    if profile.extra_words:
        dropped = dropped | F.col("term").isin(*profile.extra_words)
    if profile.noise_first:
        dropped = dropped | is_noise(F.col("term"))
    stems = stem_map(marked.filter(~dropped).select("term", "uses"), roots, profile.stemmer)
    if not profile.noise_first:
        clean = F.when(~(F.col("is_listed") | is_noise(F.col("stem"))), F.col("stem"))
        stems = _in_list(stems, "stem", stop).withColumn("stem", clean)
    gone = marked.filter(dropped).select("term", F.lit(None).cast("string").alias("stem"), "uses")
    return stems.select("term", "stem", "uses").unionByName(gone)


def map_tokens(
    tokens: DataFrame, table: DataFrame, keep_unknown: bool = False, fits: bool | None = None,
    shards: int | None = None,
) -> DataFrame:
    """Replace each token by its stem, order kept, and drop those without one, unless
    ``keep_unknown``; documents that lose all their tokens stay. ``fits``: whether the table may
    be broadcast; it is measured if not given, and so is the number of ``shards`` that the tokens are
    dealt out in."""
    if fits is None:
        fits = fits_broadcast(table)
    tokens = tokens.select(*DOCUMENT, "tokens")
    if shards is None:
        tokens = materialized(tokens)
        shards = shards_for(tokens)
    return replaced(tokens, table, shards, fits, keep_unknown)


def analyse(
    documents: DataFrame,
    profile: Profile,
    stop: StopWords,
    roots: DataFrame | None = None,
    table: DataFrame | None = None,
    fits: bool | None = None,
) -> DataFrame:
    """``(theme, doc_id, tokens)`` of a corpus under a profile.

    Without a term table of the caller it is built from the corpus. The words are then stored
    first, since both the table and the result need them.
    """
    words = documents.select(*DOCUMENT, words_of(F.col("text"), profile).alias("tokens"))
    shards = None
    if table is None:
        if roots is None:
            raise ValueError("give the root words or a term table")
        words = materialized(words)
        shards = shards_for(words)
        terms = materialized(distinct_terms(words))
        table = materialized(term_table(terms, profile, stop, roots))
    return map_tokens(words, table, fits=fits, shards=shards)


def analyse_queries(
    queries: DataFrame,
    stop: StopWords,
    roots: DataFrame | None = None,
    stems: DataFrame | None = None,
) -> DataFrame:
    """``(query_id, tokens)`` of queries ``(query_id, text)`` in the query form.

    Stop words are looked up between single blanks, other whitespace splits only afterwards,
    and there is no noise filter. Blank queries are left out. Without roots or stems the words
    stay unstemmed.
    """
    asked = queries.filter(squeeze(F.col("text")) != "")
    pieces = asked.select("query_id", F.split(query_letters(F.col("text")), " ").alias("pieces"))
    words = _short_list(stop)
    if words is not None:
        kept = pieces.select("query_id", drop_words(F.col("pieces"), words).alias("kept"))
    else:
        rows = pieces.select("query_id", F.posexplode("pieces").alias("pos", "piece"))
        entry = F.when(~F.col("is_listed"), F.struct("pos", "piece"))
        kept = (
            _in_list(rows, "piece", stop)
            .groupBy("query_id")
            .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
            .select("query_id", F.col("entries.piece").alias("kept"))
        )
    tokens = kept.select(
        "query_id", split_words(squeeze(F.array_join("kept", " "))).alias("tokens")
    )
    if stems is None and roots is not None:
        stems = materialized(stem_map(distinct_terms(tokens), roots, "indonesian"))
    if stems is None:
        return tokens
    rows = tokens.select("query_id", F.posexplode_outer("tokens").alias("pos", "term"))
    entry = F.when(F.col("term").isNotNull(), F.struct("pos", "stem"))
    return (
        stem_rows(rows, stems, ("query_id",))
        .groupBy("query_id")
        .agg(F.sort_array(F.collect_list(entry)).alias("kept"))
        .select("query_id", F.col("kept.stem").alias("tokens"))
    )


def query_text(analysed: DataFrame) -> DataFrame:
    """The analysed query as text, single blanks between the words."""
    return analysed.select("query_id", F.array_join("tokens", " ").alias("query"))
