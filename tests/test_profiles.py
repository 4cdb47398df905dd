import pytest
from pyspark.sql import functions as F

from termshard.operators import skew
from termshard.operators.skew import join_by_term
from termshard.operators.stemming import distinct_terms
from termshard.plans import cleaning, profiles as P
from termshard.sources import records, stopwords


@pytest.fixture(scope="module")
def resources(spark):
    roots = spark.createDataFrame([("makan",), ("main",), ("sapu",), ("ini",)], "term string")
    return stopwords.words_table(spark, stopwords.INDONESIAN_STOP_WORDS), roots


def texts(spark, *rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").withColumn(
        "theme", F.lit("a")
    )


def run(spark, resources, profile, *rows, **more):
    clean = P.analyse(texts(spark, *rows), profile, *resources, **more)
    return [r["tokens"] for r in clean.orderBy("doc_id").collect()]


def test_thesis(spark, resources):
    got = run(spark, resources, P.THESIS, "Makanan dan permainan hmmm running", None, "")
    assert got == [["makan", "main", "running"], [], []]


def test_headed(spark, resources):
    got = run(spark, resources, P.HEADED_THESIS, "ABSTRAKMakanan LatarBelakangMakanan Judul ini")
    assert got == [["makan", "latarbelakang", "makan"]]


def test_news_filters_after_stemming(spark, resources):
    # The stem of "inilah" is a stop word; "goes" becomes "goe", "ties" the noise "tie" is kept.
    got = run(spark, resources, P.NEWS, "Inilah monitoring makanan www.x.id @orang gas")
    assert got == [["monitor", "makan"]]


def test_essay_drops_reduplication(spark, resources):
    assert run(spark, resources, P.ESSAY, "jalan-jalan makan-makanan main") == [
        ["makan", "makan", "main"]
    ]


def test_long_stop_list_joins(spark, resources, monkeypatch):
    rows = ("makanan dan yang permainan dan", "", "dan yang", None)
    expected = run(spark, resources, P.THESIS, *rows)
    assert expected == [["makan", "main"], [], [], []]
    monkeypatch.setattr(P, "listed", lambda df, column, limit=0: None)
    assert run(spark, resources, P.THESIS, *rows) == expected
    queries = spark.createDataFrame([(1, "Makanan yang  dan ini")], "query_id bigint, text string")
    assert P.query_text(P.analyse_queries(queries, *resources)).first()["query"] == "makan"


def test_large_term_table_is_shuffled(spark, resources, monkeypatch):
    rows = ("makanan dan yang permainan dan", "", "dan yang", "monitoring", None)
    expected = run(spark, resources, P.NEWS, *rows)
    assert expected == [["makan", "main"], [], [], ["monitor"], []]
    monkeypatch.setattr(P, "fits_broadcast", lambda df: False)
    assert run(spark, resources, P.NEWS, *rows) == expected
    monkeypatch.setattr(skew, "MIN_HOT_USES", 1)
    assert run(spark, resources, P.NEWS, *rows) == expected


def test_query_profile(spark, resources):
    queries = spark.createDataFrame(
        [(1, "Makanan yang e-mail"), (2, "   "), (3, "yang\tdan makanan"), (4, "yang")],
        "query_id bigint, text string",
    )
    got = P.query_text(P.analyse_queries(queries, *resources)).orderBy("query_id").collect()
    # Query 3: a stop word glued by a tab is not seen as one.
    assert [tuple(r) for r in got] == [(1, "makan email"), (3, "yang dan makan"), (4, "")]
    plain = P.query_text(P.analyse_queries(queries, resources[0])).orderBy("query_id").collect()
    assert plain[0]["query"] == "makanan email"


def test_stems_are_needed(spark, resources):
    with pytest.raises(ValueError):
        P.analyse(texts(spark, "x"), P.NEWS, resources[0])


def test_frequent_words_are_not_shuffled(spark, resources):
    """Beyond a broadcast: a word that is everywhere is served by the broadcast part alone."""
    rows = [("t", i, ["hot"] * 3 + [f"w{i % 70}"]) for i in range(300)] + [("t", 999, [])]
    tokens = spark.createDataFrame(rows, "theme string, doc_id bigint, tokens array<string>")
    terms = distinct_terms(tokens).withColumn("stem", F.upper("term"))
    exploded = tokens.select("theme", "doc_id", F.posexplode_outer("tokens").alias("pos", "term"))
    joined = join_by_term(exploded, terms, ["term"], broadcast=False, limit=100)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan
    shuffled = exploded.dropna().join(
        terms.filter("uses > 100").select("term"), "term", "left_anti"
    )
    assert shuffled.filter("term = 'hot'").count() == 0
    got = {(r["doc_id"], r["pos"]): r["stem"] for r in joined.collect()}
    assert got == {(d, i): w.upper() for _, d, ws in rows for i, w in enumerate(ws)} | {(999, None): None}


def test_cleaning_job_counts_rows(spark, resources, tmp_path):
    raw = spark.createDataFrame([("1", "Makanan\nlezat"), ("2", ""), ("3", "main")], "id string, isi string")
    records.write_csv(raw.coalesce(1), str(tmp_path / "raw"))
    report = cleaning.clean_corpus(
        spark, str(tmp_path / "raw"), str(tmp_path / "clean"), "a", P.THESIS, *resources, repair=True
    )
    assert (report.rows_read, report.rows_written) == (3, 3)
    clean = spark.read.parquet(str(tmp_path / "clean")).orderBy("doc_id").collect()
    assert [r["tokens"] for r in clean] == [["makan", "lezat"], [], ["main"]]
