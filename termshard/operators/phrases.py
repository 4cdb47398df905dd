"""Phrases from the position lists of their words, without a row per position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def adjacent(lists: str) -> Column:
    """Whether the words of a phrase, ``lists`` of (offset, positions), stand side by side: the lists
    shifted back by their offsets have a position in common."""
    shifted = f"transform({lists}, l -> transform(l.positions, p -> p - l.offset))"
    common = f"aggregate(slice({shifted}, 2, size({lists})), {shifted}[0], (a, b) -> array_intersect(a, b))"
    return F.expr(f"size({common}) > 0")


def words_between(lists: str, words: str) -> Column:
    """How many other positions the tightest run of the words, in their order, holds; null if they
    never stand in this order.

    All positions in one sorted list, of each the offset of its word, are read once. For every
    word the latest position is kept at which a run up to that word may begin; at the last word
    such a run ends.
    """
    # One number an event: position, and later words first, so that no position serves two words.
    events = (
        f"array_sort(flatten(transform({lists}, l -> transform(l.positions, "
        f"p -> cast(p as bigint) * {words} + ({words} - 1 - l.offset)))))"
    )
    word, place = f"int({words} - 1 - e % {words})", f"e div {words}"
    begun = f"if({word} = 0, {place}, get(s.begins, {word} - 1))"
    none = f"named_struct('begins', array_repeat(bigint(null), {words}), 'least', bigint(null))"
    step = (
        f"named_struct('begins', transform(s.begins, (b, i) -> if(i = {word}, coalesce({begun}, b), b)), "
        f"'least', if({word} = {words} - 1, least(s.least, {place} - {begun}), s.least))"
    )
    return F.expr(f"aggregate({events}, {none}, (s, e) -> {step}, s -> s.least - ({words} - 1))")


def phrase_hits(found: DataFrame, keys: list[str], slops: bool) -> DataFrame:
    """``keys`` and ``score`` of the documents that hold a phrase. ``found`` has a row per document
    and word of a phrase: ``words``, their number, ``slop``, ``offset``, ``positions``, ``score``.
    Only documents with every word have their positions compared."""
    whole = found.groupBy(*keys, "words", "slop").agg(
        F.count("*").alias("matched"),
        F.sum("score").alias("score"),
        F.collect_list(F.struct("offset", "positions")).alias("lists"),
    ).filter("matched = words")
    holds = adjacent("lists")
    if slops:
        near = F.coalesce(words_between("lists", "words") <= F.col("slop"), F.lit(False))
        holds = F.when(F.col("slop") == 0, holds).otherwise(near)
    return whole.filter(holds).select(*keys, "score")
