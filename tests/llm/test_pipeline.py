from collections import Counter

import duckdb
import pytest
from brute import lowered, near_components, quality_counts

import corpus_pipeline as P
from check_oracles import rows_of
from termshard.llm import packing
from termshard.llm.oracles import llm_oracles
from termshard.llm.queries import llm_queries

FOLDER = "/root/testdata/sf0.001"


def tables():
    db = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return db


def test_stages_do_what_they_say(spark, sample):
    docs, steps = sample, {}
    for name, stage in P.STAGES:
        steps[name] = docs = P.materialized(stage(spark, docs, FOLDER))
        if name != P.STAGES[-1][0]:
            assert docs.columns == sample.columns
    # The base rule, and beyond it what the SQL of the rules rejects by its cutoffs.
    counts = {r["doc_id"]: quality_counts(r["text"]) for r in sample.collect()}
    good = {d for d, c in counts.items() if c[0] >= 10 and 100 * c[4] <= 20 * c[0]}
    judged = tables().execute(llm_oracles()["op9_risk_controlled_rules"]).df()
    kept = set(judged[judged.kept].doc_id)
    assert kept < good and len(kept) > 0.85 * len(good)
    good = kept
    rows = {r["doc_id"]: r for r in sample.collect()}
    assert {r["doc_id"] for r in steps["quality rules"].collect()} == good
    first = {}
    for d in sorted(good):
        first.setdefault(lowered(rows[d]["text"]), d)
    assert sorted(r["doc_id"] for r in steps["exact dedup"].collect()) == sorted(first.values())
    near = near_components([(d, rows[d]["text"]) for d in first.values()], 5, 80)
    kept = sorted(d for d, (_, c) in near.items() if c == d)
    assert sorted(r["doc_id"] for r in steps["MinHash near-dedup"].collect()) == kept
    mixed = Counter(r["doc_id"] for r in steps["temperature mixing"].collect())
    assert set(mixed) == set(kept) and set(mixed.values()) <= {1, 2}
    packed = steps["best-fit packing"]
    pieces = packing.cut_pieces(sample.filter(sample.doc_id.isin(kept))).collect()
    want = Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in pieces for _ in range(mixed[r["doc_id"]]))
    assert Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed.collect()) == want


def test_run_gives_the_last_stages_rows(spark, sample):
    got = P.run(spark, FOLDER)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() > 0


@pytest.mark.parametrize("table", ["odd", "none"])
def test_odd_tables_pass_through_all_stages(request, spark, table):
    docs = request.getfixturevalue(table)
    for _, stage in P.STAGES:
        docs = P.materialized(stage(spark, docs, FOLDER))
    assert (docs.count() > 0) == (table == "odd")


def test_columns_of_any_name_come_through(spark, sample):
    """Dots, quotes and blanks in the names of further columns."""
    docs = sample.limit(60).selectExpr("*", "1 AS `a.b`", "named_struct('c', doc_id) AS `d e.f`", "2 AS `x``y`")
    for _, stage in P.STAGES[:-1]:
        docs = P.materialized(stage(spark, docs, FOLDER))
        assert docs.columns[-3:] == ["a.b", "d e.f", "x`y"] and docs.count() > 0


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_queries_equal_their_sql(spark, sample, name):
    ours, theirs = llm_queries()[name](spark, FOLDER).toPandas(), tables().execute(llm_oracles()[name]).df()
    assert list(ours.columns) == list(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in llm_queries()) == list(range(1, 14))
