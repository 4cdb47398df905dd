import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _id int, _row int, root string, id string"


@pytest.fixture(scope="session")
def sample(spark):
    """The documents of the smallest tables."""
    if not Path(FOLDER).exists():
        pytest.skip("no test tables")
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls everywhere, empty and very long texts, ties, repeated rows and keys, and columns
    whose names operators may use themselves."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    texts = [
        (1, "One two three four five six seven eight nine ten eleven twelve."),
        (2, "ONE two three four five six seven eight nine ten eleven twelve."),
        (2, "ONE two three four five six seven eight nine ten eleven twelve."),
        (3, None), (4, ""), (5, " \n\t "), (6, long), (7, long), (None, "one"), (None, None),
        (8, "É é É one"), (9, "é É É one"), (10, "x" * 50_000), (11, "一 二 三 😀"), (2, "another text of key two"),
        (12, "a a a a a a a a a a a a"), (13, "line one two\nline one two\n\n\nline one two"),
    ]
    langs, sources = ["en", None, "de"], ["s", None, "t", "s", "s"]
    return [
        (d, t, langs[i % 3], sources[i % 5], None if i % 4 else 7, i, None, "r", "i")
        for i, (d, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
