import random
from collections import Counter
from math import sqrt

import pytest
from pyspark.sql import functions as F

from termshard.operators import blocks, cosine
from termshard.sources.corpora import themes_table


def asked(spark, *queries):
    rows = [(i, q.split()) for i, q in enumerate(queries)]
    return spark.createDataFrame(rows, "query_id bigint, tokens array<string>")


def brute_force(corpus, words):
    """Score per (theme, doc): norms of the query over the words its theme knows."""
    query, known = Counter(words), {}
    for theme, _, tokens in corpus:
        known.setdefault(theme, set()).update(tokens)
    out = {}
    for theme, doc, tokens in corpus:
        seen = {w: n for w, n in query.items() if w in known[theme]}
        tf = Counter(tokens)
        dot = sum(n * tf[w] for w, n in seen.items())
        if dot:
            norms = sqrt(sum(n * n for n in seen.values())) * sqrt(sum(n * n for n in tf.values()))
            out[theme, doc] = dot / norms
    return out


def hits(df):
    return [(r["theme"], r["doc_id"], round(r["similarity_score"], 6)) for r in df.orderBy("rank").collect()]


def test_tiny_collection(spark, tiny):
    index = cosine.bow_index(tiny, themes_table(spark, ["a", "b"]))
    search = lambda q: hits(cosine.search_all(asked(spark, q), index))
    assert search("kota") == [("b", 0, 1.0), ("a", 0, 0.894427)]
    assert search("kota zzz") == search("kota")
    assert search("api air") == [("a", 1, 1.0), ("b", 1, 1.0), ("a", 0, 0.447214)]
    assert search("zzz") == []


def test_equal_scores_follow_the_registry(spark, tiny):
    index = cosine.bow_index(tiny, themes_table(spark, ["b", "a"]))
    got = hits(cosine.search_all(asked(spark, "api air"), index))
    assert got == [("b", 1, 1.0), ("a", 1, 1.0), ("a", 0, 0.447214)]


QUERIES = ["hot w1 w2", "w3 w3 w4 zzz", "hot", "w39 w38 w37 w36", "nothing known"]


def scored(df):
    found = {}
    for r in df.collect():
        found.setdefault(r["query_id"], {})[r["theme"], r["doc_id"]] = r["similarity_score"]
    return found


def test_scores_equal_brute_force(spark, corpus, corpus_df):
    terms = cosine.query_terms(asked(spark, *QUERIES))
    got = scored(cosine.scores(terms, cosine.bow_index(corpus_df)))
    for i, query in enumerate(QUERIES):
        assert got.get(i, {}) == pytest.approx(brute_force(corpus, query.split()))
    assert all(0 < s <= 1 + 1e-12 for one in got.values() for s in one.values())


@pytest.mark.parametrize("limit", [3, 60, 10_000])
def test_large_batches_shuffle_and_give_the_same(spark, corpus_df, monkeypatch, limit):
    terms = cosine.query_terms(asked(spark, *QUERIES))
    index = cosine.bow_index(corpus_df)
    small = scored(cosine.scores(terms, index))
    monkeypatch.setattr(cosine, "BROADCAST_ROWS", 0)
    assert scored(cosine.scores(terms, index, limit=limit)) == small


def test_ranks(spark, corpus, corpus_df):
    queries, index = asked(spark, *QUERIES), cosine.bow_index(corpus_df)
    merged = cosine.search_all(queries, index, 7).collect()
    each = cosine.search_each(queries, index, 7).collect()
    for i, query in enumerate(QUERIES):
        expected = brute_force(corpus, query.split())
        order = sorted(expected, key=lambda k: (-round(expected[k], 12), k))
        mine = sorted((r for r in merged if r["query_id"] == i), key=lambda r: r["rank"])
        assert [(r["theme"], r["doc_id"]) for r in mine] == order[:7]
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        for theme in {t for t, _ in expected}:
            here = [k for k in order if k[0] == theme]
            ranked = sorted(
                (r for r in each if (r["query_id"], r["theme"]) == (i, theme)),
                key=lambda r: r["theme_rank"],
            )
            assert [(r["theme"], r["doc_id"]) for r in ranked] == here[:7]
            for r in mine:
                if r["theme"] == theme:
                    assert here[r["theme_rank"] - 1][1] == r["doc_id"]


def test_many_results_are_cut_in_two_steps(spark, corpus, corpus_df):
    index = cosine.bow_index(corpus_df)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        got = hits(cosine.search_all(asked(spark, "hot w1"), index, 50))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert got == hits(cosine.search_all(asked(spark, "hot w1"), index, 50))
    assert len(got) == 50


def test_one_theme(spark, corpus, corpus_df):
    index = cosine.bow_index(corpus_df)
    got = cosine.search_theme(asked(spark, "hot w1"), index, "small0", 400).collect()
    expected = {k: v for k, v in brute_force(corpus, ["hot", "w1"]).items() if k[0] == "small0"}
    assert {(r["theme"], r["doc_id"]) for r in got} == set(expected)
    assert cosine.search_theme(asked(spark, "hot"), index, "unknown").count() == 0


def test_a_document_finds_itself(spark, corpus, corpus_df):
    theme, doc, tokens = next(row for row in corpus if len(row[2]) > 5)
    got = scored(cosine.scores(cosine.query_terms(asked(spark, " ".join(tokens))), cosine.bow_index(corpus_df)))
    assert got[0][theme, doc] == pytest.approx(1.0)


def test_result_size_must_be_positive(spark, tiny):
    with pytest.raises(ValueError):
        cosine.search_all(asked(spark, "kota"), cosine.bow_index(tiny), 0)


def test_content_and_listing(spark, tiny):
    found = cosine.search_all(asked(spark, "kota"), cosine.bow_index(tiny))
    gone = spark.createDataFrame([(0, "b", 99, 0.5, 1, 3)], found.schema)
    shown = cosine.with_content(found.unionByName(gone), tiny).orderBy("rank").collect()
    assert [r["content"] for r in shown] == [["kota"], ["kota", "kota", "air"], None]
    row = cosine.listing(cosine.with_content(found, tiny)).orderBy("rank").collect()[1]
    assert (row["document"], row["score"], row["preview"]) == ("a_0", 0.8944, "kota kota air")
    assert cosine.result_counts(found).first()["n_results"] == 2


def test_scoring_needs_no_shuffle_of_postings(spark, corpus_df):
    terms = cosine.query_terms(asked(spark, "hot w1"))
    plan = cosine.scores(terms, cosine.bow_index(corpus_df))._jdf.queryExecution().executedPlan()
    lines = plan.toString().splitlines()
    joined = next(i for i, line in enumerate(lines) if "BroadcastHashJoin [theme" in line)
    assert not any("Exchange" in line for line in lines[:joined])


@pytest.mark.parametrize("n", [1, 3, 40])
def test_impact_bounds_lose_nothing(spark, corpus_df, n):
    """Frequent words, words in one document, repeated words, words nobody knows; few and many hits."""
    index = cosine.bow_index(corpus_df)
    queries = spark.createDataFrame(
        [(i, ["hot", f"w{i}", f"w{2 * i}", "w1", "w1", "unknown"][: i % 6 + 1]) for i in range(1, 20)], "query_id bigint, tokens array<string>"
    )
    rows = lambda df: sorted((r["query_id"], r["theme"], r["theme_rank"], r["doc_id"], r["similarity_score"]) for r in df.collect())
    plain = rows(cosine.search_each(queries, index, n, prune=False))
    for small in (True, False):
        assert rows(cosine.search_each(queries, index, n, small=small, prune=True)) == plain
    best = cosine.search_all(queries, index, n, prune=True).collect()
    assert sorted(map(tuple, best)) == sorted(map(tuple, cosine.search_all(queries, index, n).collect()))


def test_impact_bounds_leave_few_documents(spark):
    """Of many documents with a frequent word only those with the telling one come to be scored."""
    rows = [("t", i, ["common"] + [f"x{i}y"] * 3 + (["rare"] * 4 if i % 100 == 0 else [])) for i in range(3000)]
    tokens = spark.createDataFrame(rows, "theme string, doc_id bigint, tokens array<string>")
    index = cosine.bow_index(tokens)
    terms = cosine.query_terms(spark.createDataFrame([(1, ["common", "rare"])], "query_id bigint, tokens array<string>"))
    every = cosine.scores(terms, index)
    few = cosine.scores(terms, index, best=5, prune=True)
    assert every.count() == 3000 and few.count() == 30
    assert every.join(few, ["query_id", "theme", "doc_id", "similarity_score"], "left_semi").count() == 30


def test_large_batches_are_scored_by_cells(spark, monkeypatch):
    """The same rows as by joins, with ties, copies, null themes and documents; a null query asks nothing."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    rows = [(rng.choice(["a", "b", None]), i, [rng.choice(words) for _ in range(rng.randrange(12))]) for i in range(400)]
    rows += [("a", 1000 + i, ["w1", "w2"]) for i in range(60)] + [("b", None, ["w1", "w1", "w3"])] + rows[:5]
    tokens = spark.createDataFrame(rows, "theme string, doc_id bigint, tokens array<string>")
    asked = [(None if i == 7 else i, [rng.choice([*words, "none"]) for _ in range(rng.randrange(6))]) for i in range(100)]
    queries = spark.createDataFrame([*asked, (100, ["w1", "w2"])], "query_id bigint, tokens array<string>")
    index = cosine.bow_index(tokens)
    joined = cosine.search_each(queries, index, 3, prune=False).collect(), cosine.search_all(queries, index, 4, prune=False).collect()
    monkeypatch.setattr(cosine.impacts, "BATCH_WORDS", 1)
    monkeypatch.setattr(blocks, "SLICE_POSTINGS", 100)
    monkeypatch.setattr(blocks, "BLOCK_WORDS", 60)
    monkeypatch.setattr(cosine, "join_postings", None)  # no row per query, word and document
    cells = cosine.search_each(queries, index, 3).collect(), cosine.search_all(queries, index, 4).collect()
    for got, want in zip(cells, joined):
        assert sorted(map(str, got)) == sorted(str(r) for r in want if r["query_id"] is not None)


def test_cells_copy_neither_side(spark, monkeypatch):
    """However many blocks and slices: no exchange, the best of all themes alone, and exact large counts."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    rows = [(rng.choice("abc"), i, [rng.choice(words) for _ in range(rng.randrange(9))]) for i in range(300)]
    rows += [("a", 900 + i, ["w1"] * (5000 + i % 3) + ["w2"] * 3) for i in range(12)]
    index = cosine.bow_index(spark.createDataFrame(rows, "theme string, doc_id bigint, tokens array<string>"))
    asked = [(i, [rng.choice([*words, "none"]) for _ in range(rng.randrange(6))]) for i in range(60)] + [(77, ["w1"] * 4000 + ["w2"])]
    queries = spark.createDataFrame([*asked, (78, ["none"])], "query_id bigint, tokens array<string>")
    want = cosine.search_all(queries, index, 4, prune=False).collect()
    monkeypatch.setattr(cosine.impacts, "BATCH_WORDS", 1)
    for name, value in {"SLICE_POSTINGS": 50, "BLOCK_WORDS": 40, "CHUNK_QUERIES": 7, "PRODUCTS": 20, "DENSE": 0.3}.items():
        monkeypatch.setattr(blocks, name, value)
    found = cosine.scores(cosine.query_terms(queries), index, best=4, each=False)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    assert sorted(map(str, cosine.search_all(queries, index, 4).collect())) == sorted(map(str, want))
    nothing = cosine.query_terms(queries.filter("query_id = 78"))
    assert cosine.scores(nothing, index, best=4).count() == 0


def test_queries_beyond_a_broadcast_are_scored_by_cells(spark, corpus_df, monkeypatch):
    queries, index = asked(spark, *QUERIES), cosine.bow_index(corpus_df)
    want = cosine.search_each(queries, index, 3, prune=False).collect()
    monkeypatch.setattr(cosine, "join_postings", None)  # no row per query, word and document
    assert sorted(map(str, cosine.search_each(queries, index, 3, small=False).collect())) == sorted(map(str, want))
    one = cosine.search_each(queries, index.only("small0"), 3, small=False).collect()
    assert sorted(map(str, one)) == sorted(str(r) for r in want if r["theme"] == "small0")
