import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "checkpoint"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


TINY = [
    ("a", 0, ["kota", "kota", "air"]),
    ("a", 1, ["air"]),
    ("a", 2, []),
    ("b", 0, ["kota"]),
    ("b", 1, ["api", "air"]),
]


@pytest.fixture(scope="session")
def tiny(spark):
    return spark.createDataFrame(TINY, "theme string, doc_id bigint, tokens array<string>")


@pytest.fixture(scope="session")
def corpus(spark):
    """Random documents with one word in most of them and one theme holding most documents."""
    import random

    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for doc in range(300):
        theme = "big" if doc % 3 else f"small{doc % 2}"
        body = [rng.choice(words) for _ in range(rng.randrange(0, 30))]
        if rng.random() < 0.8:
            body += ["hot"] * rng.randrange(1, 4)
        rng.shuffle(body)
        rows.append((theme, doc, body))
    return rows


@pytest.fixture(scope="session")
def corpus_df(spark, corpus):
    return spark.createDataFrame(corpus, "theme string, doc_id bigint, tokens array<string>")
