import pytest
from pyspark.sql import types as T

from termshard.operators import stats
from termshard.sources import corpora, stopwords


def schema(**columns):
    types = {"s": T.StringType(), "i": T.LongType()}
    return T.StructType([T.StructField(n, types[k]) for n, k in columns.items()])


def test_pick_text_column():
    pick = corpora.pick_text_column
    assert pick(schema(Title="s", CONTENT="s")) == "CONTENT"
    assert pick(schema(id="i", note="s", more="s")) == "note"
    assert pick(schema(a="s", text="s"), forced="a") == "a"
    assert pick(schema(a="s", text="s"), forced="A") == "text"
    assert pick(schema(Text="s", text="s")) == "text"
    assert pick(schema(n="i", m="i"), first_if_none=True) == "n"
    with pytest.raises(ValueError):
        pick(schema(n="i"))


def test_load_goes_on_after_a_fault(spark, tmp_path, tiny):
    tiny.filter("theme = 'a'").select("doc_id", "tokens").write.parquet(str(tmp_path / "a"))
    tiny.select("doc_id").write.parquet(str(tmp_path / "bad"))
    loaded = corpora.load_corpora(
        spark,
        [
            corpora.Theme("none", str(tmp_path / "nowhere")),
            corpora.Theme("a", str(tmp_path / "a")),
            corpora.Theme("bad", str(tmp_path / "bad")),
        ],
        searchable=[],
    )
    report = {r["theme"]: r for r in loaded.report.collect()}
    assert report["a"]["loaded"] and not report["a"]["searchable"] and report["a"]["n_docs"] == 3
    assert not report["none"]["loaded"] and report["none"]["n_docs"] == 0
    assert "tokens" in report["bad"]["error"]
    assert [r["theme"] for r in loaded.themes.collect()] == ["a"]
    assert loaded.tokens.count() == 3


def test_nothing_loaded(spark, tmp_path):
    loaded = corpora.load_corpora(spark, [corpora.Theme("none", str(tmp_path / "nowhere"))])
    assert loaded.tokens is None and loaded.report.first()["n_docs"] == 0


def test_extra_stop_words(spark, tmp_path):
    (tmp_path / "extra.txt").write_text("  Foo \n\nbar\nyang\n", encoding="utf-8")
    base = stopwords.words_table(spark, ["yang", "dan"])
    extra = stopwords.read_word_file(spark, str(tmp_path / "extra.txt"))
    got = sorted(r["term"] for r in stopwords.stop_words(base, extra).collect())
    assert got == ["bar", "dan", "foo", "yang"]
    assert stopwords.spark_stop_words(spark, "english").count() > 100


def test_statistics(spark, tiny):
    themes = corpora.themes_table(spark, ["b", "a", "c"])
    rows = stats.documents_per_theme(tiny, themes).collect()
    assert [(r["theme"], r["n_docs"]) for r in rows] == [("b", 2), ("a", 3)]
    totals = {r["theme"]: r["n_docs"] for r in stats.corpus_totals(tiny).collect()}
    assert totals == {"a": 3, "b": 2, None: 5}
    assert tuple(stats.loaded_themes(tiny).first()) == (2, 5)
