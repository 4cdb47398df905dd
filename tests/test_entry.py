from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracles import TABLES, rows_of
from termshard.registry.oracles import all_oracles
from termshard.registry.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

# A few of each kind; check_oracles.py runs them all.
SOME = [
    "corpus_csv_repair", "normalize_headed", "noise_filter", "stem_map_hybrid", "profile_news",
    "bow_vectors", "cosine_all", "result_preview", "bm25_or", "phrase", "wildcard", "corpus_stats",
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", SOME)
def test_query_equals_its_oracle(spark, db, name):
    ours = entry.queries()[name](spark, FOLDER).toPandas()
    theirs = db.execute(entry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)
