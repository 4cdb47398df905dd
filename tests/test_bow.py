from collections import Counter, defaultdict
from math import sqrt

import pytest
from pyspark.sql import functions as F

from termshard.operators import bounds, bow, cosine, document_terms, fulltext, skew
from termshard.plans import profiles
from termshard.registry import queries as registered


def counts(corpus):
    return {(t, d): Counter(w for w in words if len(w) > 1) for t, d, words in corpus}


def test_frequencies_norms_and_vocabulary(corpus, corpus_df):
    expected = counts(corpus)
    got = defaultdict(dict)
    for r in bow.postings(corpus_df).collect():
        got[r["theme"], r["doc_id"]][r["term"]] = (r["tf"], r["dl"], r["norm_sq"])
    for key, terms in expected.items():
        dl, norm_sq = sum(terms.values()), sum(c * c for c in terms.values())
        assert got.get(key, {}) == {t: (c, dl, norm_sq) for t, c in terms.items()}
    stats = {(r["theme"], r["doc_id"]): (r["dl"], r["norm"]) for r in bow.doc_stats(corpus_df).collect()}
    assert stats == {
        key: (sum(t.values()), pytest.approx(sqrt(sum(c * c for c in t.values()))))
        for key, t in expected.items()
    }
    df, cf = Counter(), Counter()
    for (theme, _), terms in expected.items():
        for term, count in terms.items():
            df[theme, term] += 1
            cf[theme, term] += count
    vocabulary = bow.vocabulary(bow.postings(corpus_df)).collect()
    assert {(r["theme"], r["term"]): (r["df"], r["cf"]) for r in vocabulary} == {
        key: (df[key], cf[key]) for key in df
    }


def test_one_letter_words_are_not_counted(spark):
    df = spark.createDataFrame([("a", 1, ["x", "yy"])], "theme string, doc_id bigint, tokens array<string>")
    assert [r["term"] for r in bow.postings(df).collect()] == ["yy"]
    assert bow.doc_stats(df).first()["dl"] == 1


def test_term_ids_are_alphabetical_per_theme(spark, corpus, corpus_df):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = bow.number_terms(bow.vocabulary(bow.postings(corpus_df)))
        got = {(r["theme"], r["term"]): r["term_id"] for r in numbered.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    terms = defaultdict(set)
    for (theme, _), found in counts(corpus).items():
        terms[theme] |= set(found)
    assert got == {(t, w): i for t, ws in terms.items() for i, w in enumerate(sorted(ws))}


def test_vectors_hold_ids_in_order(corpus, corpus_df):
    postings = bow.postings(corpus_df)
    numbered = bow.number_terms(bow.vocabulary(postings))
    ids = {(r["theme"], r["term"]): r["term_id"] for r in numbered.collect()}
    expected = {
        (t, d): sorted((ids[t, w], c) for w, c in found.items())
        for (t, d), found in counts(corpus).items() if found
    }
    got = bow.vectors(postings, numbered).collect()
    assert {(r["theme"], r["doc_id"]): [tuple(e) for e in r["vector"]] for r in got} == expected


def test_documents_are_exchanged_once(corpus_df):
    plan = bow.postings(corpus_df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("limit", [1, 50, 10_000])
def test_hot_and_cold_keys_join_like_a_plain_join(corpus_df, limit):
    rows = corpus_df.select("theme", "doc_id", F.posexplode("tokens").alias("pos", "term"))
    table = (
        rows.filter("term <> 'w3'").groupBy("term").agg(F.count("*").alias("uses"))
        .withColumn("value", F.upper("term"))
    )
    got = skew.join_by_term(rows, table, ["term"], broadcast=False, limit=limit)
    expected = rows.withColumn("value", F.when(F.col("term") != "w3", F.upper("term")))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_many_values_prune_by_ranges(spark):
    values = sorted(f"w{i:03}" for i in range(0, 600, 3))
    rows = spark.createDataFrame([(f"w{i:03}",) for i in range(700)], "term string")
    kept = {r["term"] for r in rows.filter(bounds.one_of("term", values)).collect()}
    assert set(values) <= kept and len(kept) < 600
    few = rows.filter(bounds.one_of("term", values[:5])).collect()
    assert [r["term"] for r in few] == values[:5]
    assert rows.filter(bounds.one_of("term", [])).count() == 0
    n, listed = bounds.counted_values(rows.filter(rows.term.isin(values)), "term")
    assert (n, listed) == (200, values)


def test_tasks_hold_so_many_tokens(spark, corpus_df, monkeypatch):
    """Partitions follow the number of tokens, whatever the optimizer makes of their packed size."""
    tokens = corpus_df.agg(F.sum(F.size("tokens"))).first()[0]
    monkeypatch.setattr(bow, "SHARD_TOKENS", 50)
    roots = spark.createDataFrame([("w1",)], "term string")
    texts = corpus_df.select("theme", "doc_id", F.array_join("tokens", " ").alias("text"))
    for made in (bow.postings(corpus_df), cosine.bow_index(corpus_df).postings, fulltext.text_index(corpus_df).postings,
                 bow.doc_stats(corpus_df), profiles.analyse(texts, profiles.THESIS, ["w2"], roots)):
        assert made.rdd.getNumPartitions() >= tokens // 50


ODD = [
    ("a", 1, ["xx\nyy", "zz", None, "q"]), ("a", 1, ["zz", "xx"]), ("b", 2, []), ("b", 3, None), (None, 4, ["kk", "kk", "é"]),
    ("c", None, ["", "ab", "\n", "éé"]),
]


def test_tokens_travel_as_text(spark):
    """As arrays only where a token holds the break; rows of a document count together."""
    df = spark.createDataFrame(ODD, "theme string, doc_id bigint, tokens array<string>")
    dealt = bow._dealt(df, 3)
    assert dict(dealt.dtypes)["text"] == "string"
    assert [(r["theme"], r["rest"]) for r in dealt.filter("rest IS NOT NULL").collect()] == [("a", ["xx\nyy", "zz"])]
    got = {tuple(r) for r in bow.postings(df, 3).collect()}
    assert got == {
        ("a", "xx\nyy", 1, 1, 4, 6), ("a", "zz", 1, 2, 4, 6), ("a", "xx", 1, 1, 4, 6), (None, "kk", 4, 2, 2, 4),
        ("c", "ab", None, 1, 2, 2), ("c", "éé", None, 1, 2, 2),
    }


def test_vectors_are_made_of_stored_postings(spark, tmp_path):
    """The text is not analysed and dealt out again for the vectors; a theme that is null has words without ids."""
    texts = [(1, "la la die", "a"), (2, "die und la", "a"), (3, "la que", "b"), (4, "que", None), (5, None, "a")]
    spark.createDataFrame(texts, "doc_id bigint, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    made = registered.bow_vectors(spark, str(tmp_path))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "documents.parquet" not in plan
    assert {(r["theme"], r["doc_id"]): r["vector"] for r in made.collect()} == {
        ("a", 1): "0:1 1:2", ("a", 2): "0:1 1:1 2:1", ("b", 3): "0:1 1:1", (None, 4): "1",
    }


@pytest.mark.parametrize("rows", [1, 7, 10_000])
def test_vectors_are_gathered_without_a_sort(spark, corpus, corpus_df, monkeypatch, rows):
    """Entries of a document come together after the exchange, however few rows are held before it."""
    monkeypatch.setattr(document_terms, "GATHERED_ROWS", rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        postings = bow.postings(corpus_df)
        made = bow.vectors(postings, bow.number_terms(bow.vocabulary(postings)))
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.index("ObjectHashAggregate") < plan.index("Exchange hashpartitioning(doc_id") < plan.rindex("MapInArrow")
        got = {(r["theme"], r["doc_id"]): [e["tf"] for e in r["vector"]] for r in made.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {k: [c[w] for w in sorted(c)] for k, c in counts(corpus).items() if c}
