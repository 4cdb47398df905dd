"""Size checks before a broadcast or a driver-side list, and lineage cuts on shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
LISTED_VALUES = 2_000
PUSHED_VALUES = 64


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of ``df``; one aggregate job, nothing but two numbers comes back. Of text
    the length counts, of arrays, maps and structs that of their JSON form."""
    sizes = []
    for f in df.schema:
        kind = f.dataType.simpleString()
        if kind in ("string", "binary"):
            sizes.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        elif kind.startswith(("array", "map", "struct")):
            value = F.to_json(F.struct(F.col(f.name)))
            sizes.append(F.coalesce(F.octet_length(value), F.lit(0)))
        else:
            sizes.append(F.lit(16))
    text = sum(sizes, F.lit(0))
    row = df.agg(F.count("*").alias("rows"), F.sum(text.cast("bigint")).alias("bytes")).first()
    return row["rows"], row["bytes"] or 0


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    rows, size = measured_size(df)
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast after a size check; beyond the bound the join is left to shuffle."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def listed(df: DataFrame, column: str, limit: int = LISTED_VALUES) -> list | None:
    """The distinct values of a column if at most ``limit``, else None."""
    rows = df.select(column).distinct().limit(limit + 1).collect()
    return None if len(rows) > limit else sorted(r[0] for r in rows if r[0] is not None)


def counted_values(df: DataFrame, column: str) -> tuple[int, list | None]:
    """The number of rows and, if they are few enough to be pushed into a scan, the distinct
    values. One job where they are few, a second one where they are not."""
    groups = df.groupBy(column).agg(F.count("*").alias("n")).limit(LISTED_VALUES + 1).collect()
    if len(groups) > LISTED_VALUES:
        return measured_size(df)[0], None
    return sum(g["n"] for g in groups), sorted(g[0] for g in groups if g[0] is not None)


def one_of(column: str, values: list, ranges: bool = True) -> Column:
    """True for the sorted values, to prune a scan ahead of a join on them. A Parquet scan skips
    pages by single equalities, but turns an IN list into its range: beyond PUSHED_VALUES
    the filter is that many short ranges, which hold some other values too; without ``ranges``
    it stays a list, from which Spark picks the buckets of a bucketed column."""
    if not values or (len(values) > PUSHED_VALUES and not ranges):
        return F.col(column).isin(values)
    if len(values) <= PUSHED_VALUES:
        return reduce(or_, [F.col(column) == v for v in values])
    size = -(-len(values) // PUSHED_VALUES)
    parts = [values[i : i + size] for i in range(0, len(values), size)]
    return reduce(or_, [F.col(column).between(part[0], part[-1]) for part in parts])


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: that of ``spark.checkpoint.dir``, or one below the
    warehouse where it is not set."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


#: The paths made in the scope of this thread or task, if it is within one.
_scope: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (paths := _scope.get()) is not None:
        paths.append(path)
    return path


@contextmanager
def scratch_space(spark: SparkSession) -> Iterator[None]:
    """Removes at its end every stage that was stored within, by this thread. What is read lazily
    from them must be read before."""
    paths: list[str] = []
    outer = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(outer)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def materialized(df: DataFrame) -> DataFrame:
    """Cut the lineage through reliable storage, so a lost executor costs a re-read only."""
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
