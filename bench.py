"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

A search is the median of ``$BENCH_RUNS`` runs after one warm-up, a whole-corpus job one run
after one warm-up; ``value`` is the sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from termshard.operators import cosine, fulltext, stemming
from termshard.operators.bounds import materialized, scratch_path
from termshard.plans import profiles as P
from termshard.registry import queries as Q
from termshard.sources import index_store, stopwords

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
BUCKETS = int(CPUS)


def session() -> SparkSession:
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{root}/warehouse")
        .config("spark.checkpoint.dir", f"{root}/checkpoint")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_seconds(work: Callable[[], object], runs: int) -> float:
    work()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    spark = session()
    documents, words = Q.documents(spark, FOLDER), Q.tokens(spark, FOLDER)
    clean = materialized(words)
    stop, roots = Q.stop(spark), materialized(Q.roots(spark, FOLDER))

    def asked(queries):
        return P.analyse_queries(queries, stopwords.INDONESIAN_STOP_WORDS)

    batch = Q.benchmark_queries(spark, FOLDER)
    first = batch.filter("query_id = 0")
    index = index_store.build_bow_index(clean, scratch_path(spark, "bow"), BUCKETS)
    text = index_store.build_text_index(clean, scratch_path(spark, "text"), BUCKETS)
    clauses = fulltext.clauses_table(
        spark,
        [
            {"query_id": 1, "kind": "prefix", "value": "inth"},
            {"query_id": 2, "kind": "phrase", "value": "de la"},
            {"query_id": 3, "value": "the"},
            {"query_id": 3, "value": "erth", "occur": "must_not"},
        ],
    )
    others = fulltext.clauses_table(
        spark,
        [
            {"query_id": 1, "value": "erth", "occur": "must_not"},
            {"query_id": 2, "kind": "prefix", "value": "th", "occur": "must_not"},
        ],
    )
    work = {
        "normalize_tokenize": lambda: run(words),
        "stem_map": lambda: run(stemming.stem_map(stemming.distinct_terms(words), roots, "hybrid")),
        "profile_thesis": lambda: run(P.analyse(documents, P.THESIS, stop, roots)),
        "profile_news": lambda: run(P.analyse(documents, P.NEWS, stop, roots)),
        "build_bow_index": lambda: index_store.build_bow_index(
            clean, scratch_path(spark, "bow"), BUCKETS
        ),
        "build_text_index": lambda: index_store.build_text_index(
            clean, scratch_path(spark, "text"), BUCKETS
        ),
        "cosine_one_query": lambda: run(cosine.search_all(asked(first), index)),
        "cosine_batch": lambda: run(cosine.search_all(asked(batch), index)),
        "cosine_unindexed": lambda: run(cosine.search_all(asked(batch), cosine.bow_index(words))),
        "bm25_one_query": lambda: run(fulltext.search_text(first, text)),
        "bm25_batch": lambda: run(fulltext.search_text(batch, text)),
        "clauses": lambda: run(fulltext.search(clauses, text)),
        "not_only": lambda: run(fulltext.search(others, text)),
    }
    chosen = sys.argv[1:] or list(work)
    searches = ("cosine", "bm25", "clauses", "not_only")
    seconds = {
        name: median_seconds(work[name], RUNS if name.startswith(searches) else 1)
        for name in chosen
    }
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(FOLDER.rstrip("/").rsplit("sf", 1)[-1]),
                "cpus": int(CPUS),
                "documents": documents.count(),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
