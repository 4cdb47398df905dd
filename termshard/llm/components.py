"""Connected components of a table of links, by alternating large and small stars.

Every round is two grouped minima and joins on the links left; the number of rounds grows with
the logarithm of the longest chain. Nothing is collected but two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termshard.llm.common import materialized


def _state(links: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*").alias("n"), F.sum(mixed).alias("sum")).first())


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v) to (id, root): every id that has a link to another, and the smallest id
    it reaches. Repeated links, both directions and self-links are fine; no links, no rows."""
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = materialized(links.filter("u > v").distinct())
    state = _state(links)
    while state[0]:
        # Large star: every larger neighbour of u moves to u's smallest neighbour or u itself.
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: u and its smaller neighbours move to the smallest of them.
        large = materialized(large.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = materialized(moved.union(least.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, _state(links)
        if before == state:
            break
    return links.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
        links.select("v", "v").distinct()
    )
