"""Top-k per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Scores equal to this many digits tie and the keys decide. A sum of floating weights depends
# on its order in the last places, so it is compared more coarsely than a cosine.
COSINE_DIGITS = 12
SUM_DIGITS = 9
SPREAD = 256


def by_score(score: str, digits: int) -> Column:
    return F.round(F.col(score), digits).desc()


def checked_count(n: int) -> int:
    if n < 1:
        raise ValueError(f"number of results must be at least 1, not {n}")
    return n


def top_n(
    scored: DataFrame, n: int, within: list[str], order: list[Column], rank: str = "rank"
) -> DataFrame:
    """The best ``n`` rows of each group with their 1-based rank.

    Each task cuts its part of a group to ``n`` rows before the shuffle. Spark does so up to
    a threshold; above it the groups are first cut in ``SPREAD`` parts, whose best ``n`` hold
    the best ``n`` of the whole.
    """
    checked_count(n)
    threshold = int(scored.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n > threshold:
        part = F.pmod(F.xxhash64(*scored.columns), F.lit(SPREAD)).alias("spread")
        scored = _cut(scored.select("*", part), n, [*within, "spread"], order, rank).drop(
            "spread", rank
        )
    return _cut(scored, n, within, order, rank)


def _cut(rows: DataFrame, n: int, within: list[str], order: list[Column], rank: str) -> DataFrame:
    numbered = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
    return rows.withColumn(rank, numbered).filter(F.col(rank) <= n)
