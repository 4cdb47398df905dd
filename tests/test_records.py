import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from termshard.sources import corpora, literals, records


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes, so that records and quotes cross many of them."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "301")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def random_rows(seed, n=120):
    rng = random.Random(seed)
    pieces = ["a", 'say ""hi""'.replace('""', '"'), "x,y", "line\nbreak", "\n\n", " ", "é", "long" * 9]
    return [
        [str(i), "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 12))).strip() or "z"]
        for i in range(n)
    ]


def write(path, rows):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["id", "text"])
    writer.writerows(rows)
    path.write_text(out.getvalue(), encoding="utf-8")


@pytest.mark.parametrize("seed", [1, 2])
def test_fields_survive_many_splits(spark, small_splits, tmp_path, seed):
    rows = random_rows(seed)
    write(tmp_path / "c.csv", rows)
    got = records.read_csv(spark, str(tmp_path / "c.csv"))
    assert got.rdd.getNumPartitions() >= 1
    found = {r["row_no"]: [r["id"], r["text"]] for r in got.collect()}
    assert found == dict(enumerate(rows))


def test_repair_joins_lines_with_one_blank(spark, small_splits, tmp_path):
    text = 'id,text\n1,"abc\n\n def ""q"" x"\n\n   \n2,"p\x0bq r"\n3,plain\n'
    (tmp_path / "r.csv").write_text(text, encoding="utf-8")
    got = records.read_csv(spark, str(tmp_path / "r.csv"), repair=True).orderBy("row_no")
    assert [(r["row_no"], r["id"], r["text"]) for r in got.collect()] == [
        (0, "1", 'abc   def "q" x'),
        (1, "2", "p q r"),
        (2, "3", "plain"),
    ]


def test_unclosed_quote_is_kept_as_last_record(spark, tmp_path):
    (tmp_path / "u.csv").write_text('id,text\n1,ok\n2,"open\nend', encoding="utf-8")
    got = records.csv_records(spark, str(tmp_path / "u.csv"), glue=" ").orderBy("record_no")
    assert [r["record"] for r in got.collect()] == ["id,text", "1,ok", '2,"open end']


def test_carriage_returns_end_records(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes(b'id,text\r\n1,a\r\n2,"b\r\nc"\r\n')
    plain = records.read_csv(spark, str(tmp_path / "w.csv")).orderBy("row_no").collect()
    assert [(r["id"], r["text"]) for r in plain] == [("1", "a"), ("2", "b\r\nc")]
    repaired = records.read_csv(spark, str(tmp_path / "w.csv"), repair=True).orderBy("row_no")
    assert [r["text"] for r in repaired.collect()] == ["a", "b c"]


def test_documents_are_numbered_over_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for part in range(3):
        write(folder / f"part-{part}.csv", [[f"{part}-{i}", "t"] for i in range(4)])
    got = corpora.read_csv_corpus(spark, str(folder), "x", text_col="id")
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {
        p * 4 + i: f"{p}-{i}" for p in range(3) for i in range(4)
    }


def test_literals_round_trip(spark, tmp_path, tiny):
    df = tiny.withColumn("theme", F.lit("a")).withColumn("doc_id", F.monotonically_increasing_id())
    literal = tiny.select(literals.to_literal(F.col("tokens"))).first()[0]
    assert literal == "['kota', 'kota', 'air']"
    literals.write_clean_csv(df, str(tmp_path / "clean"))
    back = literals.read_clean_csv(spark, str(tmp_path / "clean"), "a").orderBy("doc_id")
    assert [r["tokens"] for r in back.collect()] == [
        r["tokens"] for r in df.orderBy("doc_id").collect()
    ]


def test_legacy_literal_with_commas_splits(spark):
    df = spark.createDataFrame([("['a,b', 'cc']",), ("[]",)], "c string").coalesce(1)
    rows = df.select(literals.from_literal(F.col("c")).alias("t")).collect()
    assert [r["t"] for r in rows] == [["a", "b", "cc"], []]


def test_missing_clean_column_names_the_columns(spark, tmp_path):
    write(tmp_path / "no.csv", [["1", "x"]])
    with pytest.raises(ValueError, match="clean_tokens.*id"):
        literals.read_clean_csv(spark, str(tmp_path / "no.csv"), "a")


@pytest.mark.parametrize("size", ["53", "301", "100000"])
@pytest.mark.parametrize("seed", [3, 4])
def test_records_and_splits_of_any_size(spark, tmp_path, seed, size):
    """Records longer than splits, splits without an end, quotes at every place, blank lines, two
    files in one task: as Python's own reader of CSV has it."""
    rng = random.Random(seed)
    folder = tmp_path / "some"
    folder.mkdir()
    want = {}
    for name in ("a", "b", "c"):
        rows = random_rows(rng.randrange(1000), 40) + [["long", "\n".join(["x" * 40, '"', ""] * 9)]]
        rng.shuffle(rows)
        write(folder / f"{name}.csv", rows)
        want |= {(name, i): r for i, r in enumerate(rows)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = records.read_rows(spark, str(folder)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {(r["file"].split("/")[-1][0], r["row_no"]): list(r["data"]) for r in got} == want
    order = sorted(got, key=lambda r: (r["file"], r["row_no"]))
    assert [r["position"] for r in order] == list(range(len(want)))


def test_lines_are_read_twice_and_records_not_shuffled(spark, tmp_path):
    write(tmp_path / "p.csv", [[str(i), f"text {i}"] for i in range(50)])
    rows = records.read_rows(spark, str(tmp_path / "p.csv"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Exchange hashpartitioning" not in plan
    assert rows.count() == 50


def test_headers_of_many_files_take_no_job_each(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(60):
        (folder / f"{i:03}.csv").write_text(f"id,text\n{i},t\n" if i % 2 else f"text,id\nt,{i}\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    rows = records.read_rows(spark, str(folder))
    jobs = len(tracker.getJobIdsForGroup("headers"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 20
    assert {r["data"]["id"] for r in rows.collect()} == {str(i) for i in range(60)}


def test_headers_with_odd_names(spark, tmp_path):
    (tmp_path / "h.csv").write_text('"a\nb",,x,X,"q""q"\n1,2,3,4,5\n')
    assert records.read_csv(spark, str(tmp_path / "h.csv")).columns == ["file", "row_no", "a\nb", "_c1", "x2", "X3", 'q"q']
    (tmp_path / "e.csv").write_text("")
    assert records.read_rows(spark, str(tmp_path / "e.csv")).count() == 0


def test_columns_may_have_any_name(spark, tmp_path):
    (tmp_path / "f.csv").write_text('File,row_no,data,text\na,b,c,"d\ne"\n')
    got = records.read_csv(spark, str(tmp_path / "f.csv"))
    assert got.columns == ["_file", "_row_no", "File", "row_no", "data", "text"]
    assert got.select("_row_no", "File", "row_no", "data", "text").first()[:] == (0, "a", "b", "c", "d\ne")
    corpus = corpora.read_csv_corpus(spark, str(tmp_path / "f.csv"), "t", text_col="File")
    assert [tuple(r) for r in corpus.collect()] == [("t", 0, "a")]


def test_files_may_order_their_columns(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.csv").write_text("id,text\n1,one\n")
    (folder / "b.csv").write_text("text,id\ntwo,2\n")
    (folder / "c.csv").write_text("id,text\n3,three\n")
    corpus = corpora.read_csv_corpus(spark, str(folder), "t", id_col="id")
    assert sorted(map(tuple, corpus.collect())) == [("t", 1, "one"), ("t", 2, "two"), ("t", 3, "three")]
    (folder / "d.csv").write_text("id,other\n4,four\n")
    with pytest.raises(ValueError):
        records.read_rows(spark, str(folder))


def test_a_quote_that_never_closes(spark, tmp_path):
    (tmp_path / "o.csv").write_text('id,text\n1,fine\n2,"open\nend\n')
    got = records.read_csv(spark, str(tmp_path / "o.csv")).orderBy("row_no").collect()
    assert [r["id"] for r in got] == ["1", "2"] and got[0]["text"] == "fine"
