from collections import defaultdict

import pytest

from termshard.operators import cosine, document_terms, fulltext
from termshard.plans import profiles as P

TOKENS = "theme string, doc_id bigint, tokens array<string>"
ODD = [
    ("a", 1, ["kota", "air", "kota"]), ("a", 1, ["air", None, "kota", "api"]),  # the same document
    ("a", 2, []), ("a", 3, None), (None, 4, ["air"]), ("b", None, ["api", "air"]), ("b", None, ["air"]), ("b", 1, ["air", "é"]),
]


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def expected_positions(rows):
    found, dl = defaultdict(list), {}
    for theme, doc_id, tokens in rows:
        for at, term in enumerate(tokens or []):
            if term is not None:
                found[theme, term, doc_id].append(at)
                dl[theme, term, doc_id] = max(dl.get((theme, term, doc_id), 0), len(tokens))
    return {k: (len(v), sorted(v), dl[k]) for k, v in found.items()}


@pytest.mark.parametrize("batch", [1, 2, 10_000])
def test_positions_of_odd_rows(spark, corpus, batch):
    for rows in (ODD, corpus):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            made = document_terms.with_positions(spark.createDataFrame(rows, TOKENS).repartition(3, "doc_id")).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        got = {(r["theme"], r["term"], r["doc_id"]): (r["tf"], r["positions"], r["dl"]) for r in made}
        assert len(got) == len(made) and got == expected_positions(rows)


@pytest.mark.parametrize("fits", [True, False])
@pytest.mark.parametrize("keep_unknown", [True, False])
def test_tokens_of_odd_rows(spark, corpus, fits, keep_unknown):
    stems = {"kota": "k", "air": "a", "api": None, "hot": "h", "w1": "w", "w2": "w"}
    table = spark.createDataFrame([(t, s, 1) for t, s in stems.items()], "term string, stem string, uses bigint")
    for rows in (ODD, corpus):
        expected = defaultdict(list)
        for theme, doc_id, tokens in rows:
            expected[theme, doc_id] += [
                (at, s) for at, t in enumerate(tokens or []) if (s := stems.get(t) or (t if keep_unknown else None))
            ]
        made = P.map_tokens(spark.createDataFrame(rows, TOKENS), table, keep_unknown, fits).collect()
        got = {(r["theme"], r["doc_id"]): r["tokens"] for r in made}
        assert len(got) == len(made) and got == {k: [s for _, s in sorted(v)] for k, v in expected.items()}


def test_no_rows(spark):
    none = spark.createDataFrame([], TOKENS)
    table = spark.createDataFrame([], "term string, stem string, uses bigint")
    assert document_terms.with_positions(none).count() == 0
    assert P.map_tokens(none, table).count() == 0


def test_every_step_of_a_search_reads_stored_rows(spark, corpus_df):
    for index in (fulltext.text_index(corpus_df), cosine.bow_index(corpus_df)):
        for part in (index.postings, index.vocabulary):
            assert not {"Generate", "Aggregate", "MapInArrow"} & {w.strip("+-: ") for w in plan(part).split()}


def test_tokens_are_replaced_without_a_row_per_token(spark, corpus_df):
    table = spark.createDataFrame([("hot", "h", 1)], "term string, stem string, uses bigint")
    for fits in (True, False):
        assert "Generate" not in plan(P.map_tokens(corpus_df, table, fits=fits))
