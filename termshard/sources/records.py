"""CSV whose quoted fields span lines, read in splits.

A multi-line CSV scan takes one task per file. Here the file is scanned as text lines, so a
large file is read by many tasks: a line ends a record when the number of quote characters
up to it is even. A first pass stores the split table: per split its quotes, the records that end
in it for an even and for an odd start, and, of a file's first split, the header. It tells how
every split starts and where its records and documents are numbered from. In the second pass
each task puts the records of its splits together; nothing is shuffled but the pieces of records
that lie across splits, for which, where the table shows such, the lines are read once more.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termshard.operators.bounds import BROADCAST_ROWS, broadcast_if_small, materialized

# Breaks, other than newline and carriage return, at which a line ends.
OTHER_LINE_BREAKS = r"[\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
BLANK_LINE = r"^[ \t\r]*$"

# Columns of parsed rows; the data are in a struct, so that their names cannot clash.
FILE, ROW_NO, DATA = "file", "row_no", "data"
#: The number of a row over all files, in the order of their names.
POSITION = "position"

CSV_OPTIONS = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
MAX_HEADERS = 1_000
SPLITS = "key bigint, split bigint, quotes bigint, if_even bigint, if_odd bigint, header string"
RECORDS = "key bigint, split bigint, record_no bigint, whole boolean, record string"


def _lines(spark: SparkSession, path, every_break: bool) -> DataFrame:
    """Lines in the order of their file, with the split they begin in; a file goes by the 64-bit
    hash of its name."""
    reader = spark.read if every_break else spark.read.option("lineSep", "\n")
    return reader.text(path).select(
        F.xxhash64(F.col("_metadata.file_path")).alias("key"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("value").alias("line"),
    )


def _runs(batches: Iterator[pa.RecordBatch], every_break: bool) -> Iterator[tuple]:
    """Key, split, further columns of the first row, and lines, for as many rows of a batch as are
    of one split; a task reads a split from its beginning to its end."""
    for batch in batches:
        key, split = (batch.column(c).to_numpy() for c in ("key", "split"))
        if not len(key):
            continue
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (split[1:] != split[:-1])])
        for at, to in zip(starts, np.r_[starts[1:], len(key)]):
            part = batch.slice(at, to - at)
            lines = part.column("line").cast(pa.large_string())
            if every_break:
                lines = pc.split_pattern_regex(lines, OTHER_LINE_BREAKS).flatten()
            yield int(key[at]), int(split[at]), part.slice(0, 1).to_pylist()[0], lines


def _states(lines: pa.Array, odd: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether quotes are odd after each line, given the start, and whether the line is blank."""
    quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
    blank = pc.match_substring_regex(lines, BLANK_LINE).to_numpy(zero_copy_only=False)
    return (np.cumsum(quotes) + odd) % 2 == 1, blank


def split_table(spark: SparkSession, path, every_break: bool = False, glue: str = "\n") -> DataFrame:
    """The first pass, stored: one row per split, SPLITS and what follows from those before it in
    the file: ``starts_odd``, ``first_record``, ``ends``, the records that end in it, ``ends_odd``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, odd, ends, header = None, 0, [0, 0], None

        def row():
            text = None if header is None or header[0] is None else glue.join(header[0]).removesuffix("\r")
            values = [[at[0]], [at[1]], [odd], [ends[0]], [ends[1]], [text]]
            types = [pa.int64()] * 5 + [pa.string()]
            names = ["key", "split", "quotes", "if_even", "if_odd", "header"]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=names)

        for key, split, _, lines in _runs(batches, every_break):
            if (key, split) != at:
                if at is not None:
                    yield row()
                at, odd, ends = (key, split), 0, [0, 0]
                header = [[], False] if split == 0 else None
            after, blank = _states(lines, odd)
            if header is not None and not header[1]:
                first = np.flatnonzero(~after & ~blank)
                header[1] = len(first) > 0
                upto = first[0] + 1 if len(first) else len(lines)
                before = np.r_[odd == 1, after[:-1]][:upto]
                own = np.flatnonzero(~blank[:upto] | before)
                header[0] += [lines[i].as_py() for i in own.tolist()]
            ends[0] += int((~after & ~blank).sum())
            ends[1] += int((after & ~blank).sum())
            odd = int(after[-1]) if len(after) else odd
        if at is not None:
            yield row()

    found = materialized(_lines(spark, path, every_break).mapInArrow(work, SPLITS))
    before = Window.partitionBy("key").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts_odd = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    ends = F.when(F.col("starts_odd"), F.col("if_odd")).otherwise(F.col("if_even"))
    told = found.withColumn("starts_odd", starts_odd).withColumn("ends", ends)
    return materialized(
        told.withColumn("first_record", F.coalesce(F.sum("ends").over(before), F.lit(0)))
        .withColumn("ends_odd", F.col("starts_odd") != (F.col("quotes") % 2 == 1))
        .drop("if_even", "if_odd", "quotes")
    )


def _assembled(lines: DataFrame, splits: DataFrame, glue: str, every_break: bool) -> DataFrame:
    """RECORDS: the whole records of each split, and the pieces of those that lie across splits."""
    table = splits.select("key", "split", F.col("starts_odd").cast("int").alias("odd"), "first_record")
    # Four numbers a split. It must be a broadcast: a shuffle would not keep the order of the lines.
    if (n := table.count()) > BROADCAST_ROWS:
        raise ValueError(f"{n} splits: read with a larger spark.sql.files.maxPartitionBytes")
    joined = lines.join(F.broadcast(table), ["key", "split"], "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, odd, number, begun, cut = None, 0, 0, [], False
        sep = pa.scalar(glue, pa.large_string())

        def rows(numbers, texts, whole):
            n = len(texts)
            texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
            columns = [pa.array(np.full(n, at[0])), pa.array(np.full(n, at[1])), pa.array(numbers, pa.int64()),
                       pa.array(np.full(n, whole)), texts.cast(pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["key", "split", "record_no", "whole", "record"])

        for key, split, first, lines in _runs(batches, every_break):
            if (key, split) != at:
                if begun:
                    yield rows([number], [glue.join(begun)], False)
                if first["odd"] is None:
                    raise ValueError("the splits of a file are not those of the first pass")
                at, odd, number, begun, cut = (key, split), first["odd"], first["first_record"], [], first["odd"] == 1
            after, blank = _states(lines, odd)
            kept = np.flatnonzero(~blank | after)  # blank lines between records go
            if not len(kept):
                continue
            ended = (~after & ~blank)[kept]
            lines = lines.take(pa.array(kept))
            stops = np.flatnonzero(ended) + 1
            bounds = np.unique(np.r_[0, stops, len(lines)])
            lists = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), lines)
            texts = pc.binary_join(lists, sep)
            n = len(stops)  # of the joined texts so many end here; one more may be open
            done = texts.slice(0, n)
            if n and begun:
                begun.append(done[0].as_py())
                yield rows([number], [glue.join(begun)], not cut)
                done, number, begun, cut, n = done.slice(1), number + 1, [], False, n - 1
            elif n and cut:
                yield rows([number], done.slice(0, 1), False)
                done, number, cut, n = done.slice(1), number + 1, False, n - 1
            if n:
                yield rows(np.arange(number, number + n), done, True)
                number += n
            if len(texts) > len(stops):
                begun.append(texts[len(stops)].as_py())
            odd = int(after[-1])
        if begun:
            yield rows([number], [glue.join(begun)], False)

    return joined.mapInArrow(work, RECORDS)


def _records(spark: SparkSession, path, splits: DataFrame, glue: str, every_break: bool) -> DataFrame:
    """``(key, record_no, record)`` of all files, from their split table."""
    found = _assembled(_lines(spark, path, every_break), splits, glue, every_break)
    records = found.filter("whole").select("key", "record_no", "record")
    if not splits.filter("ends_odd").isEmpty():
        pieces = F.transform(F.sort_array(F.collect_list(F.struct("split", "record"))), lambda p: p["record"])
        across = found.filter("NOT whole").groupBy("key", "record_no")
        records = records.unionByName(across.agg(F.array_join(pieces, glue).alias("record")))
    return records.withColumn("record", F.regexp_replace("record", r"\r$", ""))


def _files(spark: SparkSession, path) -> DataFrame:
    """``(key, file)`` of the files of a scan; their contents are not read."""
    name = F.col("_metadata.file_path")
    return spark.read.format("binaryFile").load(path).select(F.xxhash64(name).alias("key"), name.alias(FILE))


def csv_records(spark: SparkSession, path, glue: str = "\n", every_break: bool = False) -> DataFrame:
    """Whole records ``(file, record_no, record)``, numbered from 0 in file order.

    ``glue`` joins the lines of one record: a newline keeps the field as it is, a blank
    flattens it. With ``every_break`` a line also ends at the less usual line separators.
    Blank lines between records are left out; a last record whose quote never closes is kept.
    """
    splits = split_table(spark, path, every_break, glue)
    records = _records(spark, path, splits, glue, every_break)
    return records.join(broadcast_if_small(_files(spark, path)), "key").select(FILE, "record_no", "record")


def safe_header(record: str) -> list[str]:
    """Column names of a header record: an empty name is numbered, as are repeated ones."""
    names = next(csv.reader(io.StringIO(record, newline="")), [])
    lower = [n.lower() for n in names]
    return [
        f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)
    ]


def _file_table(spark: SparkSession, path, splits: DataFrame) -> tuple[DataFrame, list[list[str]]]:
    """Per file its key, name, the number of its first row over all files, and which of the headers,
    given as well, it has. One row a file is ordered; only the distinct headers are listed."""
    ended = F.sum("ends") + F.max_by(F.col("ends_odd").cast("int"), "split") - 1
    own = splits.groupBy("key").agg(ended.alias("rows"), F.max("header").alias("header"))
    files = materialized(_files(spark, path).join(own, "key"))
    before = Window.orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("offset", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    kinds = files.groupBy("header").agg(F.min(FILE).alias("first"), F.count("*").alias("n"))
    kinds = kinds.orderBy("first").limit(MAX_HEADERS + 1).collect()
    if len(kinds) > MAX_HEADERS:
        raise ValueError(f"the files have more than {MAX_HEADERS} different headers")
    headers = [safe_header(k["header"]) for k in kinds]
    for kind, names in zip(kinds, headers):
        if sorted(names) != sorted(headers[0]):
            raise ValueError(f"{kind['first']} has the columns {names}, others have {headers[0]}")
    which = F.array_position(F.array(*(F.lit(k["header"]) for k in kinds)), F.col("header")) if kinds else F.lit(0)
    return files.select("key", FILE, "offset", which.cast("int").alias("kind")), headers


def read_rows(spark: SparkSession, path, repair: bool = False) -> DataFrame:
    """Rows (FILE, ROW_NO, POSITION, DATA) of a CSV with header, newlines inside quotes allowed: the
    file, the position in it and over all files, and a struct of string fields.

    Fields are matched by name, so files may order their columns differently; files with other
    columns than the first are an error. With ``repair`` the lines of a broken record are joined
    by one blank.
    """
    glue = " " if repair else "\n"
    splits = split_table(spark, path, repair, glue)
    files, headers = _file_table(spark, path, splits)
    records = _records(spark, path, splits, glue, repair).join(broadcast_if_small(files), "key")
    data = F.struct()
    for kind, header in reversed(list(enumerate(headers, 1))):
        ddl = ", ".join(f"`{c.replace('`', '``')}` string" for c in header)
        parsed = F.from_csv("record", ddl, CSV_OPTIONS)
        if header != headers[0]:
            parsed = F.struct(*(parsed[c].alias(c) for c in headers[0]))
        data = parsed if kind == len(headers) else F.when(F.col("kind") == kind, parsed).otherwise(data)
    row_no = F.col("record_no") - 1
    return records.filter(F.col("record_no") > 0).select(
        FILE, row_no.alias(ROW_NO), (F.col("offset") + row_no).alias(POSITION), data.alias(DATA)
    )


def read_csv(spark: SparkSession, path, repair: bool = False) -> DataFrame:
    """``read_rows`` with the data as columns. The columns for file and position in it get underscores
    in front where the data have columns of these names."""
    rows = read_rows(spark, path, repair)
    taken = {c.lower() for c in rows.schema[DATA].dataType.fieldNames()}
    places = []
    for name in (FILE, ROW_NO):
        free = name
        while free in taken:
            free = f"_{free}"
        places.append(F.col(name).alias(free))
    return rows.select(*places, f"{DATA}.*")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, every field quoted, quotes doubled: what ``read_csv`` reads back."""
    (
        df.write.option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )
