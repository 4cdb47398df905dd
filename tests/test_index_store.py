import pytest

from termshard.operators import cosine, fulltext
from termshard.sources import index_store
from termshard.sources.corpora import themes_table


def asked(spark, text):
    return spark.createDataFrame([(1, text.split())], "query_id bigint, tokens array<string>")


@pytest.fixture(scope="module")
def stored(corpus_df, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("index"))
    index_store.build_bow_index(corpus_df, f"{folder}/bow", buckets=4)
    index_store.build_text_index(corpus_df, f"{folder}/text", buckets=4)
    index_store.save_tokens(corpus_df, f"{folder}/tokens", buckets=4)
    return folder


def forget_tables(spark):
    """What a new session knows: nothing of the tables, only the files."""
    for table in spark.catalog.listTables():
        if table.name.startswith("termshard_"):
            spark.sql(f"DROP TABLE {table.name}")


def test_a_new_session_finds_the_same(spark, corpus_df, stored):
    forget_tables(spark)
    reopened = index_store.open_bow_index(spark, f"{stored}/bow")
    query = asked(spark, "hot w1 w2")
    assert sorted(cosine.search_all(query, reopened, 20).collect()) == sorted(
        cosine.search_all(query, cosine.bow_index(corpus_df), 20).collect()
    )
    text = index_store.open_text_index(spark, f"{stored}/text")
    rows = fulltext.clauses_table(spark, [dict(query_id=1, value="hot"), dict(query_id=1, value="w1")])
    fresh = fulltext.search(rows, fulltext.text_index(corpus_df)).collect()
    assert sorted(fulltext.search(rows, text).collect()) == sorted(fresh)
    tokens = index_store.open_tokens(spark, f"{stored}/tokens")
    assert sorted(map(repr, tokens.select(corpus_df.columns).collect())) == sorted(
        map(repr, corpus_df.collect())
    )
    assert index_store.searchable_themes(reopened) == ["big", "small0", "small1"]
    assert index_store.searchable_themes(text) == ["big", "small0", "small1"]


def test_search_prunes_themes_and_shuffles_no_postings(spark, stored):
    index = index_store.open_bow_index(spark, f"{stored}/bow").only("big")
    scores = cosine.scores(cosine.query_terms(asked(spark, "hot w1")), index)
    lines = scores._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(line for line in lines if "FileScan" in line and "_postings" in line)
    assert "Bucketed: true" in scan and "Or(EqualTo(term,hot),EqualTo(term,w1))" in scan and "theme=big" in scan
    joined = next(i for i, line in enumerate(lines) if "BroadcastHashJoin [theme" in line)
    assert not any("Exchange" in line for line in lines[:joined])


def test_content_is_fetched_by_bucket(spark, stored):
    tokens = index_store.open_tokens(spark, f"{stored}/tokens").filter("doc_id in (1)")
    plan = tokens.groupBy("doc_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 1 out of 4" in plan and "Exchange" not in plan


def test_registered_order_is_kept(spark, tiny, tmp_path):
    themes = themes_table(spark, ["b", "a"])
    index = index_store.build_bow_index(tiny, str(tmp_path / "bow"), 2, themes)
    got = cosine.search_all(asked(spark, "api air"), index).orderBy("rank").collect()
    assert [(r["theme"], r["doc_id"]) for r in got] == [("b", 1), ("a", 1), ("a", 0)]


def test_a_theme_without_words_is_not_searchable(spark, tmp_path):
    tokens = spark.createDataFrame(
        [("full", 1, ["kata"]), ("empty", 1, [])], "theme string, doc_id bigint, tokens array<string>"
    )
    index = index_store.build_bow_index(tokens, str(tmp_path / "bow"), 2)
    assert index_store.searchable_themes(index) == ["full"]
