"""Joins on a term, where a frequent word may own a large part of all rows.

The right side of a join by term counts how often each key is used on the left (``uses``). Its
most used keys, as many as a broadcast may hold, never enter a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termshard.operators.bounds import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    broadcast_if_small,
    fits_broadcast,
    materialized,
)

HOT_KEYS = 1_000
MIN_HOT_USES = 1_000_000
HOT_ROW_BYTES = 256


def hot_limit(uses_total: int | None) -> int:
    return max(MIN_HOT_USES, (uses_total or 0) // HOT_KEYS)


def join_by_term(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    document: tuple[str, ...] = ("theme", "doc_id"),
    broadcast: bool | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Left join of ``rows`` to a table with one row per key and a column ``uses``.

    A small table is broadcast. Of a large one the most used keys are: rows with such a key
    take their values from the broadcast, rows without a key take none, and only the others
    are shuffled. With ``limit`` the keys used more than that are the hot ones.
    """
    values = [c for c in table.columns if c not in keys and c != "uses"]
    if fits_broadcast(table) if broadcast is None else broadcast:
        return rows.join(F.broadcast(table.drop("uses")), keys, "left")
    table = table.dropna(subset=keys)
    hot = most_used(table, keys, limit)
    known, other = hot.select(*keys), rows.dropna(subset=keys)
    served = other.join(F.broadcast(hot.drop("uses")), keys)
    cold = table.join(F.broadcast(known), keys, "left_anti").drop("uses")
    shuffled = other.join(F.broadcast(known), keys, "left_anti").join(cold, keys, "left")
    types = {f.name: f.dataType for f in table.schema}
    nothing = [F.lit(None).cast(types[v]).alias(v) for v in values]
    keyless = rows.filter(" OR ".join(f"`{k}` IS NULL" for k in keys)).select("*", *nothing)
    columns = [*rows.columns, *values]
    return served.select(columns).unionByName(shuffled.select(columns)).unionByName(keyless)


def most_used(table: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame:
    """The rows of the most used keys within the bounds of a broadcast, stored. Rows longer than
    HOT_ROW_BYTES are left out, so their number bounds their size."""
    if limit is not None:
        return materialized(table.filter(F.col("uses") > limit))
    strings = [f.name for f in table.schema if f.dataType.simpleString() == "string"]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in strings), F.lit(0))
    rows = min(BROADCAST_ROWS, BROADCAST_BYTES // (2 * HOT_ROW_BYTES))
    ranked = table.filter(size <= HOT_ROW_BYTES).orderBy(F.desc("uses"), *keys)
    return materialized(ranked.limit(rows))


def join_postings(
    postings: DataFrame,
    wanted: DataFrame,
    vocabulary: DataFrame,
    small: bool,
    limit: int | None = None,
) -> DataFrame:
    """Inner join of postings and query terms on ``(theme, term)``.

    A small query side is broadcast. Beyond that both sides are shuffled; the postings of a
    term are cut into slices by document and its query rows repeated once per slice, so that
    neither many postings nor many queries of a term make a large task.
    """
    keys = ["theme", "term"]
    if small:
        return postings.join(F.broadcast(wanted), keys)
    if limit is None:
        limit = hot_limit(vocabulary.agg(F.sum("df")).first()[0])
    # Rows that a term gives: its postings times its queries. As there are fewer slices than
    # postings, a slice has at least one.
    asked = wanted.groupBy(*keys).agg(F.count("*").alias("asked"))
    pairs = vocabulary.join(asked, keys).select(
        *keys, F.least("df", F.ceil(F.col("df") * F.col("asked") / limit)).alias("slices")
    )
    hot = broadcast_if_small(materialized(pairs.filter("slices > 1")))
    slices = F.coalesce("slices", F.lit(1).cast("bigint"))
    sliced = (
        postings.join(hot, keys, "left")
        .withColumn("slice", F.pmod(F.xxhash64("doc_id"), slices))
        .drop("slices")
    )
    repeated = (
        wanted.join(hot, keys, "left")
        .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1)))
        .drop("slices")
    )
    return sliced.join(repeated, [*keys, "slice"]).drop("slice")
