"""Exact duplicates by sorting contents.

Normalised texts are range-partitioned by sampled splitters, sorted within the ranges, and
equal texts, then neighbours, form a group. The splitters are of bounded size: the first
bytes of a text and a hash of it, so neither long texts nor a common first line matter.

A text that more than ``1 / (4 * partitions)`` of all rows share is dealt over as many
sub-ranges as its share asks for; at most ``4 * partitions`` texts are that frequent, and
their sub-groups, at most ``8 * partitions``, are merged in a second small aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termshard.llm.common import ascii_lower, materialized, partitions, whole, whole_row

SPLITTER_CHARS = 16


def frequent_contents(keys: DataFrame, rows: int, limit: int) -> list[tuple[int, int]]:
    """(hash, parts) of the hashes that more than ``limit`` rows have: fewer than
    ``rows / limit`` of them, whatever the data."""
    if rows <= limit:
        return []
    counted = keys.groupBy("_hash").agg(F.count("*").alias("n")).filter(F.col("n") > limit)
    return [(r["_hash"], -(-r["n"] // limit)) for r in counted.collect()]


def _grouped(docs: DataFrame, text: str, key: str, keep: str, carry: bool) -> DataFrame:
    """``_id``, ``_keep``, ``_size``, ``_kept``, ``_sha`` of every row; with ``carry`` the whole
    row too, as ``_row``, and only of rows that stay."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    spark = docs.sparkSession
    first = F.desc_nulls_last if keep == "largest" else F.asc_nulls_last
    parts = partitions(spark)
    # lower() unites at least what lower-casing A-Z unites, and is cheaper: good for a hash.
    low = F.lower(whole(text))
    base = docs.select(
        F.col(key).alias("_id"), F.xxhash64(low).alias("_hash"),
        F.substring(low, 1, SPLITTER_CHARS).alias("_start"),
        whole_row(docs) if carry else F.struct(text).alias("_row"),
    )
    rows = docs.count()
    frequent = frequent_contents(base, rows, max(64, rows // (4 * parts)))
    ranges = ["_start", "_hash"]  # all of them in the window's keys, which so need no exchange
    if frequent:
        hot = spark.createDataFrame(frequent, "_hash bigint, _parts bigint")
        base = base.join(F.broadcast(hot), "_hash", "left")  # fewer than 4 * parts rows
        part = F.coalesce(F.pmod(F.xxhash64("_id"), F.col("_parts")), F.lit(0))
        base, ranges = base.withColumn("_part", part), [*ranges, "_part"]
    dealt = base.repartitionByRange(*ranges)
    content = dealt.withColumn("_norm", ascii_lower(whole(F.col("_row")[text])))
    same = Window.partitionBy(*ranges, "_norm")
    ordered = same.orderBy(first("_id"))
    columns = ["_id", "_hash"] + ["_parts"] * bool(frequent) + ["_row"] * carry
    groups = content.select(
        *columns, F.sha2(F.col("_norm").cast("binary"), 256).alias("_sha"),
        F.first("_id").over(ordered).alias("_keep"),
        (F.row_number().over(ordered) == 1).alias("_kept"),
        F.count("*").over(same).alias("_size"),
    )
    if carry:
        groups = groups.filter("_kept")
    if not frequent:
        return groups
    groups = materialized(groups)
    pick = F.max if keep == "largest" else F.min
    merged = (
        groups.filter("_kept AND _parts IS NOT NULL")
        .groupBy("_hash", "_sha")
        .agg(pick("_keep").alias("_best"), F.sum("_size").alias("_total"))
    )  # at most one row per sub-range of a frequent hash: fewer than 8 * parts
    united = F.col("_total").isNotNull()
    return groups.join(F.broadcast(merged), ["_hash", "_sha"], "left").withColumns(
        {
            "_kept": F.col("_kept") & (~united | F.col("_keep").eqNullSafe(F.col("_best"))),
            "_keep": F.when(united, F.col("_best")).otherwise(F.col("_keep")),
            "_size": F.coalesce("_total", "_size"),
        }
    )


def content_groups(
    docs: DataFrame, text: str = "text", key: str = "doc_id", keep: str = "smallest"
) -> DataFrame:
    """One row per row of ``docs``: the key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal if they are identical once A-Z are lower-cased; null is the empty text.
    ``keep`` says whether the smallest or the largest key of a group stays. Exactly one row of
    a group is kept: of repeated rows with the same key, one. A null key stays only where
    no row of the group has a key. Other columns are ignored; no rows give no rows.
    """
    return _grouped(docs, text, key, keep, carry=False).select(
        F.col("_id").alias(key), F.col("_keep").alias("keep_id"),
        F.col("_size").cast("bigint").alias("group_size"), F.col("_kept").alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, text: str = "text", key: str = "doc_id", keep: str = "smallest"
) -> DataFrame:
    """The rows of ``docs`` that ``content_groups`` keeps, with all their columns: of nulls and empty
    texts, which are equal, one, and of repeated rows one. No rows give no rows."""
    return _grouped(docs, text, key, keep, carry=True).filter("_kept").select("_row.*")
