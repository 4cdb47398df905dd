"""Operators as queries: ``(spark, folder of Parquet tables) -> DataFrame``.

The corpus is ``documents`` with its source as the theme; ``benchmark`` holds the queries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termshard.functions import display, normalize as N, tokens as K
from termshard.operators import bow, cosine, fulltext, stats, stemming
from termshard.operators.bounds import materialized, scratch_path
from termshard.operators.stem_english import english_stem
from termshard.operators.stem_indonesian import with_indonesian_stem
from termshard.plans import cleaning, profiles as P
from termshard.sources import corpora, index_store, literals, records, stopwords

Query = Callable[[SparkSession, str], DataFrame]

STOP_LIST = sorted({*stopwords.INDONESIAN_STOP_WORDS, *K.ENGLISH_STOP_WORDS})
ONE_THEME = "src1"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return corpora.as_documents(_table(spark, folder, "documents"), "source", "doc_id")


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    words = K.split_words(N.plain(F.col("text")))
    return documents(spark, folder).select("theme", "doc_id", words.alias("tokens"))


def stop(spark: SparkSession) -> DataFrame:
    return stopwords.words_table(spark, STOP_LIST)


def roots(spark: SparkSession, folder: str) -> DataFrame:
    """Root words for the tests: the words of the conversations."""
    words = K.split_words(N.plain(F.col("text")))
    said = _table(spark, folder, "conversations").select(F.explode_outer(words).alias("term"))
    return said.filter("term is not null").distinct()


def benchmark_queries(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def spoken_queries(spark: SparkSession, folder: str) -> DataFrame:
    said = _table(spark, folder, "conversations")
    return said.select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text")


def analysed(queries: DataFrame) -> DataFrame:
    return P.analyse_queries(queries, stopwords.INDONESIAN_STOP_WORDS)


def _joined(column: str) -> Column:
    return F.array_join(column, " ").alias(column)


# --- sources and sinks ---------------------------------------------------------------------


def corpus_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "corpus-csv")
    records.write_csv(_table(spark, folder, "documents"), path)
    rows = records.read_csv(spark, path)
    return rows.select(
        F.col("source").alias("theme"), F.col("doc_id").cast("bigint").alias("doc_id"), "text"
    )


def corpus_csv_repair(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "corpus-csv")
    records.write_csv(_table(spark, folder, "documents"), path)
    rows = records.read_csv(spark, path, repair=True)
    return rows.select(
        F.col("source").alias("theme"), F.col("doc_id").cast("bigint").alias("doc_id"), "text"
    )


def token_literal_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "clean-csv")
    one_theme = tokens(spark, folder).withColumn("theme", F.lit("all"))
    literals.write_clean_csv(one_theme, path)
    back = literals.read_clean_csv(spark, path, "all")
    return back.select("theme", "doc_id", _joined("tokens"))


def token_literals(spark: SparkSession, folder: str) -> DataFrame:
    literal = literals.to_literal(F.col("tokens")).alias("clean_tokens")
    return tokens(spark, folder).select("theme", "doc_id", literal)


def pick_text_column(spark: SparkSession, folder: str) -> DataFrame:
    picked = None
    for name in ("documents", "pages", "benchmark", "conversations"):
        table = _table(spark, folder, name)
        column = corpora.pick_text_column(table.schema)
        row = table.agg(
            F.count("*").alias("n_rows"), F.sum(F.length(column)).alias("n_chars")
        ).select(F.lit(name).alias("table_name"), F.lit(column).alias("text_column"), "n_rows",
                 "n_chars")
        picked = row if picked is None else picked.unionByName(row)
    return picked


def document_keys(spark: SparkSession, folder: str) -> DataFrame:
    key = display.document_key(F.col("theme"), F.col("doc_id")).alias("id")
    return documents(spark, folder).select(key, F.length("text").cast("bigint").alias("n_chars"))


def extra_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    """The words of the benchmark, written in capitals between blanks, as the extra file."""
    path = scratch_path(spark, "extra-words")
    words = K.split_words(N.plain(F.col("text")))
    lines = F.concat(F.lit("  "), F.upper("term"), F.lit(" "))
    _table(spark, folder, "benchmark").select(F.explode(words).alias("term")).select(
        lines.alias("value")
    ).write.text(path)
    return stopwords.stop_words(stop(spark), stopwords.read_word_file(spark, path))


def load_report(spark: SparkSession, folder: str) -> DataFrame:
    """A clean corpus, the same as list literals without an index, and one that is missing."""
    clean, literal = scratch_path(spark, "clean"), scratch_path(spark, "clean-csv")
    source = tokens(spark, folder)
    source.select("doc_id", "tokens").write.parquet(clean)
    literals.write_clean_csv(source, literal)
    loaded = corpora.load_corpora(
        spark,
        [
            corpora.Theme("stored", clean),
            corpora.Theme("listed", literal, "literal"),
            corpora.Theme("missing", clean + "-none"),
        ],
        searchable=["stored"],
    )
    return loaded.report.select(
        "theme",
        F.col("ordinal").cast("bigint").alias("ordinal"),
        F.col("loaded").cast("bigint").alias("loaded"),
        F.col("searchable").cast("bigint").alias("searchable"),
        "n_docs",
        F.col("error").isNotNull().cast("bigint").alias("failed"),
    )


def cleaning_job(spark: SparkSession, folder: str) -> DataFrame:
    """CSV in, clean tokens out, read back from the partitioned table."""
    source, target = scratch_path(spark, "raw-csv"), scratch_path(spark, "clean")
    records.write_csv(_table(spark, folder, "documents"), source)
    cleaning.clean_corpus(
        spark, source, target, "all", P.THESIS, stop(spark), roots(spark, folder),
        id_col="doc_id", repair=True,
    )
    return spark.read.parquet(target).select("theme", "doc_id", _joined("tokens"))


def cleaning_report(spark: SparkSession, folder: str) -> DataFrame:
    source, target = scratch_path(spark, "raw-csv"), scratch_path(spark, "clean")
    records.write_csv(_table(spark, folder, "documents"), source)
    report = cleaning.clean_corpus(
        spark, source, target, "all", P.THESIS, stop(spark), roots(spark, folder), id_col="doc_id"
    )
    row = (report.theme, report.rows_read, report.rows_written)
    return spark.createDataFrame([row], "theme string, rows_read bigint, rows_written bigint")


def column_check(spark: SparkSession, folder: str) -> DataFrame:
    """Which tables have a text column, by the check that a load makes, and their rows."""
    checked = None
    for name in ("documents", "pages", "benchmark", "labels"):
        table, found = _table(spark, folder, name), 1
        try:
            literals.require_column(table, "text")
        except ValueError:
            found = 0
        row = table.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), F.lit(found).cast("bigint").alias("found"), "n_rows"
        )
        checked = row if checked is None else checked.unionByName(row)
    return checked


def blank_and_null(spark: SparkSession, folder: str) -> DataFrame:
    """Beside every text a missing and a blank one, which have no words and ask nothing."""
    own = documents(spark, folder).select((F.col("doc_id") * 3).alias("query_id"), "text")
    given = own
    for kind, text in ((1, F.lit(" \t ")), (2, F.lit(None).cast("string"))):
        given = given.unionByName(own.select((F.col("query_id") + kind).alias("query_id"), text.alias("text")))
    words = given.select("query_id", F.size(K.split_words(N.plain(F.col("text")))).alias("n"))
    asked = analysed(given).select("query_id", F.lit(1).cast("bigint").alias("asked"))
    return words.join(asked, "query_id", "left").select(
        "query_id", F.greatest(F.col("n"), F.lit(0)).cast("bigint").alias("n_tokens"),
        F.coalesce("asked", F.lit(0).cast("bigint")).alias("asked"),
    )


def stored_tokens(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    index_store.save_tokens(tokens(spark, folder), path)
    stored = index_store.open_tokens(spark, path)
    return stored.select("theme", "doc_id", _joined("tokens"))


def searchable_report(spark: SparkSession, folder: str) -> DataFrame:
    """A corpus with an index, one without, one of empty documents, and one that is missing."""
    full, empty = scratch_path(spark, "clean"), scratch_path(spark, "clean")
    words = tokens(spark, folder)
    words.select("doc_id", "tokens").write.parquet(full)
    nothing = F.array().cast("array<string>").alias("tokens")
    words.select("doc_id", nothing).write.parquet(empty)
    themes = [
        corpora.Theme("indexed", full), corpora.Theme("unindexed", full),
        corpora.Theme("empty", empty), corpora.Theme("missing", full + "-none"),
    ]
    loaded = corpora.load_corpora(spark, themes)
    index = index_store.build_bow_index(
        loaded.tokens.filter("theme IN ('indexed', 'empty')"), scratch_path(spark, "bow")
    )
    report = corpora.load_corpora(spark, themes, index=index).report
    return report.select(
        "theme", F.col("loaded").cast("bigint").alias("loaded"),
        F.col("searchable").cast("bigint").alias("searchable"), "n_docs",
    )


# --- normal forms and token filters --------------------------------------------------------


def _normal_form(form: str, text: Callable[[Column], Column] = lambda c: c) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        normalized = N.normalize(text(F.col("text")), form).alias("normalized")
        return documents(spark, folder).select("theme", "doc_id", normalized)

    return run


def normalize_pages(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "pages").select(
        "page_id", N.plain(F.col("html")).alias("normalized"), N.plain(F.col("url")).alias("place")
    )


def with_headers(text: Column) -> Column:
    parts = (F.lit("ABSTRAK"), text, F.lit(" Latar Belakang"), text, F.lit(" Judul"), text)
    return F.concat(*parts)


def doubled(text: Column) -> Column:
    """Words of even length doubled, the others followed by a longer form of themselves."""
    return F.array_join(
        F.transform(
            K.split_words(N.plain(text)),
            lambda w: F.when(F.length(w) % 2 == 0, F.concat_ws("-", w, w)).otherwise(
                F.concat(w, F.lit("-"), w, F.lit("an"))
            ),
        ),
        " ",
    )


def _token_query(change: Callable[[Column], Column], text=lambda c: c, form="plain") -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        words = K.split_words(N.normalize(text(F.col("text")), form))
        kept = documents(spark, folder).select("theme", "doc_id", change(words).alias("tokens"))
        return kept.select("theme", "doc_id", _joined("tokens"))

    return run


def tokenize(spark: SparkSession, folder: str) -> DataFrame:
    return tokens(spark, folder).select(
        "theme", "doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), _joined("tokens")
    )


def query_analysis(spark: SparkSession, folder: str) -> DataFrame:
    return P.query_text(analysed(benchmark_queries(spark, folder)))


# --- stemming and profiles -----------------------------------------------------------------


def _stems(stemmer: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        terms = stemming.distinct_terms(tokens(spark, folder))
        stems = stemming.stem_map(terms, roots(spark, folder), stemmer)
        return stems.select("term", "stem", "uses")

    return run


#: Affixes around a root or, after ``-``, around a root without its first letter; ``.`` is the place
#: of an infix. Every rule of the Indonesian stemmer is used by some of them.
AFFIXES = """ke_ di_ se_ ber_ be_ bel_ te_ ter_ me_ mem_ mempe_ men_ meng_ menge_ meny_ pe_ per_ pem_
    pen_ peng_ penge_ peny_ pel_ ku_ kau_ mem-_ men-_ meng-_ meny-_ pem-_ pen-_ peng-_ peny-_ _er. _el. _em.
    _in. _lah _kah _tah _pun _ku _mu _nya _i _kan _an _is _isme _isasi di_kan diper_kan ke_an ber_an
    per_an memper_i peng_annya me_kannyalah ke_i di_an ter_in.""".split()


def made_words(roots: DataFrame) -> DataFrame:
    """Every root with each of the affixes."""
    root = F.col("term")
    words = []
    for affix in AFFIXES:
        before, after = affix.split("_")
        body = F.substring(root, F.lit(2), F.length(root)) if before.endswith("-") else root
        if after.endswith("."):
            body, after = F.concat(F.left(root, F.lit(1)), F.lit(after[:-1]), F.substring(root, F.lit(2), F.length(root))), ""
        words.append(F.concat(F.lit(before.rstrip("-")), body, F.lit(after)))
    return roots.select(F.explode(F.array(root, *words)).alias("term")).distinct()


def stem_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Made words, so that every rule of the Indonesian stemmer is used."""
    known = roots(spark, folder)
    return with_indonesian_stem(made_words(known), known, roots_fit=True, stem="stem")


def stem_many_roots(spark: SparkSession, folder: str) -> DataFrame:
    """The same as it runs where the roots are too many for a broadcast."""
    known = roots(spark, folder)
    return with_indonesian_stem(made_words(known), known, roots_fit=False, stem="stem", hot=50)


def stem_english(spark: SparkSession, folder: str) -> DataFrame:
    terms = stemming.distinct_terms(tokens(spark, folder))
    return terms.select("term", english_stem("term").alias("stem"))


def stem_tokens(spark: SparkSession, folder: str) -> DataFrame:
    words = materialized(tokens(spark, folder))
    stems = stemming.stem_map(materialized(stemming.distinct_terms(words)), roots(spark, folder), "hybrid")
    stemmed = P.map_tokens(words, materialized(stems), keep_unknown=True, shards=bow.shards_for(words))
    return stemmed.select("theme", "doc_id", _joined("tokens"))


def stemmed_queries(spark: SparkSession, folder: str) -> DataFrame:
    queries = P.analyse_queries(
        benchmark_queries(spark, folder), stop(spark), roots(spark, folder)
    )
    return P.query_text(queries)


def _profile(profile: P.Profile, text: Callable[[Column], Column] = lambda c: c) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        given = documents(spark, folder).withColumn("text", text(F.col("text")))
        clean = P.analyse(given, profile, stop(spark), roots(spark, folder))
        return clean.select("theme", "doc_id", _joined("tokens"))

    return run


def profile_large_terms(spark: SparkSession, folder: str) -> DataFrame:
    """A profile as it runs where the table of words is too large for a broadcast."""
    clean = P.analyse(
        documents(spark, folder), P.THESIS, stop(spark), roots(spark, folder), fits=False
    )
    return clean.select("theme", "doc_id", _joined("tokens"))


# --- bag of words --------------------------------------------------------------------------


def term_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    return bow.term_frequencies(tokens(spark, folder))


def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    numbered = bow.number_terms(bow.vocabulary(bow.postings(tokens(spark, folder))))
    return numbered.select("theme", "term", "term_id", "df", "cf")


def doc_norms(spark: SparkSession, folder: str) -> DataFrame:
    norms = bow.doc_stats(tokens(spark, folder))
    return norms.select("theme", "doc_id", "dl", F.round("norm", 6).alias("norm"))


def bow_vectors(spark: SparkSession, folder: str) -> DataFrame:
    postings = materialized(bow.postings(tokens(spark, folder)))
    numbered = bow.number_terms(bow.vocabulary(postings))
    entry = F.transform("vector", lambda e: F.concat_ws(":", e["term_id"], e["tf"]))
    vectors = bow.vectors(postings, numbered)
    return vectors.select("theme", "doc_id", F.array_join(entry, " ").alias("vector"))


def query_vectors(spark: SparkSession, folder: str) -> DataFrame:
    terms = cosine.query_terms(analysed(benchmark_queries(spark, folder)))
    weights = cosine.query_weights(terms, bow.vocabulary(bow.postings(tokens(spark, folder))))
    norm = F.round(F.sqrt(F.col("q_norm_sq").cast("double")), 6).alias("query_norm")
    return weights.select("query_id", "theme", "term", "qtf", norm)


# --- cosine search -------------------------------------------------------------------------


def _shown(hits: DataFrame, score: str = "similarity_score") -> DataFrame:
    ints = [c for c in ("theme_rank", "rank") if c in hits.columns]
    return hits.select(
        "query_id",
        "theme",
        "doc_id",
        F.round(score, 6).alias(score),
        *[F.col(c).cast("bigint").alias(c) for c in ints],
    )


def cosine_single(spark: SparkSession, folder: str) -> DataFrame:
    index = cosine.bow_index(tokens(spark, folder))
    queries = analysed(benchmark_queries(spark, folder))
    return _shown(cosine.search_theme(queries, index, ONE_THEME))


def cosine_each(spark: SparkSession, folder: str) -> DataFrame:
    index = cosine.bow_index(tokens(spark, folder))
    queries = analysed(benchmark_queries(spark, folder))
    return _shown(cosine.search_each(queries, index, 3))


def cosine_all(spark: SparkSession, folder: str) -> DataFrame:
    index = cosine.bow_index(tokens(spark, folder))
    return _shown(cosine.search_all(analysed(benchmark_queries(spark, folder)), index))


def cosine_large_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The search as it runs where the queries are too many for a broadcast."""
    index = cosine.bow_index(tokens(spark, folder))
    queries = analysed(benchmark_queries(spark, folder))
    return _shown(cosine.search_each(queries, index, 3, small=False))


def cosine_pruned(spark: SparkSession, folder: str) -> DataFrame:
    """The search as a large batch runs it, by impact bounds."""
    index = cosine.bow_index(tokens(spark, folder))
    queries = analysed(benchmark_queries(spark, folder))
    return _shown(cosine.search_each(queries, index, 3, prune=True))


def cosine_batch(spark: SparkSession, folder: str) -> DataFrame:
    index = cosine.bow_index(tokens(spark, folder))
    return _shown(cosine.search_all(analysed(spoken_queries(spark, folder)), index, 10))


def cosine_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same search over an index on disk, themes in reverse order of their names."""
    words = tokens(spark, folder)
    names = [r["theme"] for r in words.select("theme").distinct().collect()]
    registry = corpora.themes_table(spark, sorted(names, reverse=True))
    index = index_store.build_bow_index(words, scratch_path(spark, "bow"), themes=registry)
    return _shown(cosine.search_all(analysed(benchmark_queries(spark, folder)), index))


def cosine_with_content(spark: SparkSession, folder: str) -> DataFrame:
    words = tokens(spark, folder)
    queries = analysed(benchmark_queries(spark, folder))
    hits = cosine.with_content(cosine.search_all(queries, cosine.bow_index(words)), words)
    return hits.select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "theme", "doc_id",
        _joined("content"),
    )


def result_preview(spark: SparkSession, folder: str) -> DataFrame:
    words = tokens(spark, folder)
    queries = analysed(benchmark_queries(spark, folder))
    hits = cosine.with_content(cosine.search_all(queries, cosine.bow_index(words)), words)
    return cosine.listing(hits).withColumn("rank", F.col("rank").cast("bigint"))


def result_counts(spark: SparkSession, folder: str) -> DataFrame:
    index = cosine.bow_index(tokens(spark, folder))
    queries = analysed(benchmark_queries(spark, folder))
    return cosine.result_counts(cosine.search_each(queries, index))


# --- full text -----------------------------------------------------------------------------


def postings(spark: SparkSession, folder: str) -> DataFrame:
    positions = F.array_join(F.transform("positions", lambda p: p.cast("string")), " ")
    return fulltext.text_postings(tokens(spark, folder)).select(
        "theme", "term", "doc_id", "tf", positions.alias("positions"), "dl"
    )


def term_stats(spark: SparkSession, folder: str) -> DataFrame:
    index = fulltext.text_index(tokens(spark, folder))
    return index.vocabulary.join(index.corpus_stats, "theme").select(
        "theme", "term", "df", "cf", "n_docs", F.round("avg_dl", 6).alias("avg_dl")
    )


def _hits(hits: DataFrame) -> DataFrame:
    return hits.select(
        "query_id", "id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank")
    )


def bm25_and(spark: SparkSession, folder: str) -> DataFrame:
    index = fulltext.text_index(tokens(spark, folder))
    return _hits(fulltext.search_text(benchmark_queries(spark, folder), index))


def bm25_or(spark: SparkSession, folder: str) -> DataFrame:
    index = fulltext.text_index(tokens(spark, folder))
    clauses = fulltext.text_clauses(benchmark_queries(spark, folder), occur="should")
    return _hits(fulltext.search(clauses, index))


def bm25_large_batch(spark: SparkSession, folder: str) -> DataFrame:
    index = fulltext.text_index(tokens(spark, folder))
    clauses = fulltext.text_clauses(benchmark_queries(spark, folder), occur="should")
    return _hits(fulltext.search(clauses, index, small=False))


def bm25_pruned(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "text")
    index = index_store.build_text_index(tokens(spark, folder), path)
    clauses = fulltext.text_clauses(benchmark_queries(spark, folder), occur="should")
    return _hits(fulltext.search(clauses, index, prune=True))


def bm25_stored(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "text")
    index = index_store.build_text_index(tokens(spark, folder), path)
    clauses = fulltext.text_clauses(benchmark_queries(spark, folder), occur="should")
    return _hits(fulltext.search(clauses, index))


# What a user would type, as clauses; the oracle reads the same rows.
CLAUSE_QUERIES: dict[str, list[dict]] = {
    "bool_not": [
        dict(query_id=1, clause_id=0, value="inth"),
        dict(query_id=1, clause_id=1, value="erth", occur="must_not"),
        dict(query_id=2, clause_id=0, value="la", occur="should"),
        dict(query_id=2, clause_id=1, value="die", occur="should"),
        dict(query_id=2, clause_id=2, value="en", occur="must_not"),
        dict(query_id=3, clause_id=0, value="the", occur="must_not"),
    ],
    "phrase": [
        dict(query_id=1, clause_id=0, kind="phrase", value="in die"),
        dict(query_id=2, clause_id=0, kind="phrase", value="De la"),
        dict(query_id=3, clause_id=0, kind="phrase", value="of the en the la"),
        dict(query_id=4, clause_id=0, kind="phrase", value="que la que", boost=2.0),
        dict(query_id=5, clause_id=0, kind="phrase", value="was"),
    ],
    "prefix": [
        dict(query_id=1, clause_id=0, kind="prefix", value="inth"),
        dict(query_id=2, clause_id=0, kind="prefix", value="zzz"),
        dict(query_id=3, clause_id=0, kind="prefix", value="ment"),
        dict(query_id=3, clause_id=1, kind="term", value="la"),
    ],
    "wildcard": [
        dict(query_id=1, clause_id=0, kind="wildcard", value="in?h*"),
        dict(query_id=2, clause_id=0, kind="wildcard", value="*keit"),
        dict(query_id=3, clause_id=0, kind="wildcard", value="q?e", boost=0.5),
        dict(query_id=4, clause_id=0, kind="wildcard", value="*ich*"),
        dict(query_id=5, clause_id=0, kind="wildcard", value="?e*en*s*"),
        dict(query_id=6, clause_id=0, kind="wildcard", value="????????????????*"),
    ],
    "term_range": [
        dict(query_id=1, clause_id=0, kind="range", value="inta", upper="inth"),
        dict(query_id=2, clause_id=0, kind="range", value="y", upper="zb"),
    ],
    "clause_analysis": [
        dict(query_id=1, clause_id=0, value="the"),
        dict(query_id=1, clause_id=1, value="INTH"),
        dict(query_id=2, clause_id=0, kind="phrase", value="of the"),
        dict(query_id=2, clause_id=1, value="la"),
        dict(query_id=3, clause_id=0, kind="prefix", value="Inth"),
        dict(query_id=4, clause_id=0, value="que la que de"),
        dict(query_id=5, clause_id=0, kind="wildcard", value="IN?H*"),
        dict(query_id=6, clause_id=0, kind="range", value="INTA", upper="INTH"),
    ],
    "open_range": [
        dict(query_id=1, clause_id=0, kind="range", value="zu"),
        dict(query_id=2, clause_id=0, kind="range", value=None, upper="ac"),
        dict(query_id=3, clause_id=0, kind="range", value="in", upper="ind", exclude_value=True),
        dict(query_id=4, clause_id=0, kind="range", value="in", upper="inth", exclude_upper=True),
    ],
    "only_not": [
        dict(query_id=1, clause_id=0, value="la", occur="must_not"),
        dict(query_id=1, clause_id=1, kind="prefix", value="th", occur="must_not"),
        dict(query_id=2, clause_id=0, value="zzzzz", occur="must_not"),
        dict(query_id=3, clause_id=0, value="die"),
        dict(query_id=3, clause_id=1, value="ein", occur="must_not"),
    ],
    "boosted": [
        dict(query_id=1, clause_id=0, value="inth", occur="should", boost=3.0),
        dict(query_id=1, clause_id=1, value="erth", occur="should"),
        dict(query_id=2, clause_id=0, value="la", boost=0.25),
        dict(query_id=2, clause_id=1, value="que", occur="should", boost=4.0),
    ],
    "phrase_slop": [
        dict(query_id=1, clause_id=0, kind="phrase", value="la que", slop=3),
        dict(query_id=2, clause_id=0, kind="phrase", value="die la que", slop=12, boost=2.0),
        dict(query_id=3, clause_id=0, kind="phrase", value="la la", slop=6),
        dict(query_id=4, clause_id=0, kind="phrase", value="que la", slop=1),
        dict(query_id=4, clause_id=1, kind="phrase", value="la que", occur="must_not"),
        dict(query_id=5, clause_id=0, kind="phrase", value="la die la", slop=20),
    ],
    "nested_clauses": [
        # la, or die without que; but not en. Three levels.
        dict(query_id=1, clause_id=0, kind="group"),
        dict(query_id=1, clause_id=1, parent=0, occur="should", value="la"),
        dict(query_id=1, clause_id=2, parent=0, occur="should", kind="group", boost=2.0),
        dict(query_id=1, clause_id=3, parent=2, value="die"),
        dict(query_id=1, clause_id=4, parent=2, occur="must_not", value="que"),
        dict(query_id=1, clause_id=5, occur="must_not", value="en"),
        # inth, or neither la nor die.
        dict(query_id=2, clause_id=0, occur="should", value="inth"),
        dict(query_id=2, clause_id=1, occur="should", kind="group", boost=0.5),
        dict(query_id=2, clause_id=2, parent=1, occur="must_not", value="la"),
        dict(query_id=2, clause_id=3, parent=1, occur="must_not", value="die"),
        # erth, and (not la).
        dict(query_id=3, clause_id=0, value="erth"),
        dict(query_id=3, clause_id=1, kind="group"),
        dict(query_id=3, clause_id=2, parent=1, occur="must_not", value="la"),
        # Not (neither la nor both que and die).
        dict(query_id=4, clause_id=0, kind="group", occur="must_not"),
        dict(query_id=4, clause_id=1, parent=0, occur="must_not", value="la"),
        dict(query_id=4, clause_id=2, parent=0, occur="must_not", kind="group"),
        dict(query_id=4, clause_id=3, parent=2, value="que"),
        dict(query_id=4, clause_id=4, parent=2, value="die"),
        dict(query_id=4, clause_id=5, value="en", occur="should", boost=3.0),
        # Not (la and que), and a group whose words are all left out.
        dict(query_id=5, clause_id=0, kind="group", occur="must_not"),
        dict(query_id=5, clause_id=1, parent=0, value="la"),
        dict(query_id=5, clause_id=2, parent=0, value="que"),
        dict(query_id=5, clause_id=3, kind="group"),
        dict(query_id=5, clause_id=4, parent=3, value="the of"),
    ],
    "every_document": [
        dict(query_id=1, clause_id=0, kind="every"),
        dict(query_id=2, clause_id=0, kind="every", boost=2.5),
        dict(query_id=2, clause_id=1, occur="must_not", value="la"),
        dict(query_id=3, clause_id=0, kind="every", boost=0.5),
        dict(query_id=3, clause_id=1, value="inth"),
        dict(query_id=4, clause_id=0, kind="every", occur="must_not"),
        dict(query_id=4, clause_id=1, value="la"),
        dict(query_id=5, clause_id=0, kind="every", occur="should"),
        dict(query_id=5, clause_id=1, kind="wildcard", value="*keit", occur="should"),
    ],
    "by_id": [
        dict(query_id=1, clause_id=0, kind="id", value="src1_1"),
        dict(query_id=1, clause_id=1, kind="id", value="src2_2", occur="should"),
        dict(query_id=2, clause_id=0, kind="id", value="src0_0", occur="should", boost=2.0),
        dict(query_id=2, clause_id=1, kind="id", value="src3_3", occur="should"),
        dict(query_id=2, clause_id=2, kind="id", value="src4_999999999", occur="should"),
    ],
}


def _clause_query(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        index = fulltext.text_index(tokens(spark, folder))
        clauses = fulltext.clauses_table(spark, CLAUSE_QUERIES[name])
        return _hits(fulltext.search(clauses, index))

    return run


# --- statistics ----------------------------------------------------------------------------


def corpus_stats(spark: SparkSession, folder: str) -> DataFrame:
    totals = stats.corpus_totals(tokens(spark, folder))
    return totals.withColumn("is_total", F.col("is_total").cast("bigint"))


def stats_ordered(spark: SparkSession, folder: str) -> DataFrame:
    words = tokens(spark, folder)
    names = sorted((r["theme"] for r in words.select("theme").distinct().collect()), reverse=True)
    counted = stats.documents_per_theme(words, corpora.themes_table(spark, names))
    return counted.select("theme", F.col("ordinal").cast("bigint").alias("ordinal"), "n_docs")


def loaded_themes(spark: SparkSession, folder: str) -> DataFrame:
    return stats.loaded_themes(tokens(spark, folder))


def all_queries() -> dict[str, Query]:
    return {
        "corpus_csv_roundtrip": corpus_csv_roundtrip,
        "corpus_csv_repair": corpus_csv_repair,
        "token_literals": token_literals,
        "token_literal_roundtrip": token_literal_roundtrip,
        "pick_text_column": pick_text_column,
        "document_keys": document_keys,
        "extra_stopwords": extra_stopwords,
        "load_report": load_report,
        "cleaning_job": cleaning_job,
        "normalize_plain": _normal_form("plain"),
        "normalize_quoted": _normal_form("quoted"),
        "normalize_query": _normal_form("query"),
        "normalize_headed": _normal_form("headed", with_headers),
        "normalize_redup": _normal_form("reduplicated", doubled),
        "normalize_pages": normalize_pages,
        "tokenize": tokenize,
        "stopword_filter": _token_query(lambda t: K.drop_words(t, STOP_LIST)),
        "keyword_filter": _token_query(
            lambda t: K.drop_words(t, K.HEADER_WORDS), with_headers, "headed"
        ),
        "noise_filter": _token_query(K.drop_noise),
        "query_analysis": query_analysis,
        "stem_map": _stems("indonesian"),
        "stem_map_hybrid": _stems("hybrid"),
        "stem_english": stem_english,
        "stem_tokens": stem_tokens,
        "stemmed_queries": stemmed_queries,
        "profile_thesis": _profile(P.THESIS),
        "profile_headed": _profile(P.HEADED_THESIS, with_headers),
        "profile_news": _profile(P.NEWS),
        "profile_essay": _profile(P.ESSAY, doubled),
        "term_frequencies": term_frequencies,
        "vocabulary": vocabulary,
        "doc_norms": doc_norms,
        "bow_vectors": bow_vectors,
        "query_vectors": query_vectors,
        "cosine_single": cosine_single,
        "cosine_each": cosine_each,
        "cosine_all": cosine_all,
        "cosine_batch": cosine_batch,
        "cosine_stored": cosine_stored,
        "cosine_with_content": cosine_with_content,
        "result_preview": result_preview,
        "result_counts": result_counts,
        "postings": postings,
        "term_stats": term_stats,
        "bm25_and": bm25_and,
        "bm25_or": bm25_or,
        "bm25_stored": bm25_stored,
        **{name: _clause_query(name) for name in CLAUSE_QUERIES},
        "corpus_stats": corpus_stats,
        "loaded_themes": loaded_themes,
        **{f.__name__: f for f in (
            cleaning_report, column_check, blank_and_null, stored_tokens, searchable_report,
            profile_large_terms, cosine_large_batch, bm25_large_batch, stats_ordered, stem_rules,
            stem_many_roots, cosine_pruned, bm25_pruned,
        )},
    }
