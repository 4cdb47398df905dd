"""Near-duplicates by one-permutation hashing.

A text is the set of its shingles, runs of words, as 64-bit hashes. One hash a shingle deals
the set into bins; the least hash of a bin is its value, and an empty bin borrows from the
first filled one in a random order of its own (optimal densification). Bands of bins are
bucket keys.

Links are found and confirmed on full sets in steps, each on less than the one before:

1. Texts with equal sets are one class. Classes are numbered, and these numbers, not the keys of
   documents, are the ids of all steps: a key may have texts of several classes.
2. Of the sets that share a bucket with another, the shingles that no other of them holds are
   counted. They bound how similar a set can be to any other, and two sets to each other,
   so many sets and pairs need no comparison.
3. Stars: in a bucket, every member is compared with one centre, the member with the least
   share of shingles of its own: where copies vary one text, that is the one nearest to it.
4. Buckets whose members are then in several components: a link between two of them is
   possible only if the bound of step 2 allows it and their distances to the centre differ by at
   most 1 - similarity (Jaccard distance is a metric). Members outside the bucket's
   largest component are compared with those. In buckets of more than FEW members pairs come
   from a join on rare shingles instead (prefix and position filter), whose rows don't grow
   with the square of the bucket. Either way no link is lost.

With 48 bands of 6 a pair at similarity 0.85 shares no bucket with probability 1e-10, at 0.8
(64 bands of 6 are taken there) with 4e-9.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termshard.llm.common import materialized, whole_row
from termshard.llm.components import components
from termshard.llm.encoding import byte_slices
from termshard.operators.bounds import broadcast_if_small

ROWS = 6
FEW = 32
SLICE_BYTES = 2 << 20
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def bands_for(similarity: float, missed: float = 5e-9) -> int:
    """Bands of ROWS bins so that a pair at ``similarity`` misses all with less than ``missed``."""
    return math.ceil(math.log(missed) / math.log1p(-(similarity**ROWS)) / 8) * 8


def finish(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(33))) * MIX[0]
    h = (h ^ (h >> np.uint64(29))) * MIX[1]
    return h ^ (h >> np.uint64(32))


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """The sorted set of hashes of the text's runs of ``width`` words, A-Z lower-cased; of the
    whole sequence where there are fewer words; nothing without words."""
    words = (text or b"").lower().split()  # of bytes: ASCII letters, and the six ASCII blanks
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    runs = max(1, n - width + 1)
    mixed = np.full(runs, min(n, width), np.uint64)
    for i in range(min(n, width)):
        mixed = mixed * MIX[2] + finish(h[i : i + runs] + MIX[3] * np.uint64(i))
    return np.unique(finish(mixed))


@lru_cache(4)
def lenders(bins: int) -> tuple[np.ndarray, np.ndarray]:
    """For each bin an order of all bins, and the place of each bin in that order."""
    order = np.argsort(np.random.default_rng(bins).random((bins, bins)), axis=1)
    place = np.argsort(order, axis=1)
    return order, place


def signature(s: np.ndarray, bins: int) -> np.ndarray:
    """The least hash of each bin, borrowed where the bin is empty. ``s`` sorted, not empty."""
    which = ((s >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    first = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
    filled = which[first].astype(np.int64)
    values = np.zeros(bins, np.uint64)
    values[filled] = s[first]
    has = np.zeros(bins, bool)
    has[filled] = True
    empty = np.flatnonzero(~has)
    if len(empty):
        order, place = lenders(bins)
        if len(filled) <= 24:
            lender = filled[np.argmin(place[np.ix_(empty, filled)], axis=1)]
            values[empty] = values[lender]
        else:
            todo, t = empty, 0
            while len(todo):
                lender = order[todo, t]
                ok = has[lender]
                values[todo[ok]] = values[lender[ok]]
                todo, t = todo[~ok], t + 1
    return values


def band_keys(values: np.ndarray, bands: int) -> np.ndarray:
    parts = values.reshape(bands, ROWS)
    keys = np.arange(bands, dtype=np.uint64)
    for i in range(ROWS):
        keys = finish(keys * MIX[4] + parts[:, i])
    return keys


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """A batch and its texts in slices of about SLICE_BYTES, which bound the sets held at once."""
    at = 0
    for texts in byte_slices(batch.column(1), SLICE_BYTES):
        yield batch.slice(at, len(texts)), texts
        at += len(texts)


def _signatures(width: int, bands: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chain.from_iterable(map(_slices, batches)):
            sizes, codes, keys = [], [], []
            for body in texts:
                s = shingles(body.as_py(), width)
                sizes.append(len(s))
                codes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(band_keys(signature(s, bands * ROWS), bands).view(np.int64) if len(s) else None)
            lists = pa.array(keys, pa.list_(pa.int64()))
            columns = [rows.column(0), rows.column(2), pa.array(sizes, pa.int64()), pa.array(codes, pa.binary()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "mark", "n", "code", "keys"])

    return work


def _sets(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chain.from_iterable(map(_slices, batches)):
            sets = [shingles(body.as_py(), width) for body in texts]
            codes = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            lists = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column(0), codes, lists], names=["id", "code", "shingles"])

    return work


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the size of the intersection and of both sets, from full sets."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_x"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("_y"))
    joined = pairs.join(one, "a").join(two, "b")
    return joined.select(
        "a", "b", F.size(F.array_intersect("_x", "_y")).cast("bigint").alias("both"),
        F.size("_x").cast("bigint").alias("na"), F.size("_y").cast("bigint").alias("nb"),
    )


def _linked(percent: int) -> Column:
    return F.expr(f"100 * both >= {percent} * (na + nb - both)")


def _rare_pairs(docs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ``docs`` (id, n, root, outside) that may be linked, by prefix and position.

    With the shingles of all sets in one order, rarest first, two linked sets have a shingle in
    common among the first of each, as many as may be missing and one; and at the first they
    have in common, what follows must be enough for the similarity. One of a pair is outside.
    """
    held = sets.join(docs, "id").select("id", "n", "root", "outside", F.explode("shingles").alias("s"))
    count = held.groupBy("s").agg(F.count("*").alias("df"))
    order = Window.partitionBy("id").orderBy("df", "s")
    first = held.join(count, "s").withColumn("at", F.row_number().over(order) - 1)
    first = materialized(first.filter(f"at <= n - ceil({percent} * n / 100)"))
    x, y = first.filter("outside").alias("x"), first.alias("y")
    may_link = (
        (F.col("x.s") == F.col("y.s")) & (F.col("x.root") != F.col("y.root"))
        & (~F.col("y.outside") | (F.col("x.id") < F.col("y.id")))
        & F.expr(f"(100 + {percent}) * least(x.n - x.at, y.n - y.at) >= {percent} * (x.n + y.n)")
    )
    return x.join(y, may_link).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def _mark(text: str) -> Column:
    """Tells the texts of one key apart."""
    return F.xxhash64(F.col(text).cast("binary"))


def _judged(docs: DataFrame, width: int, percent: int, text: str, key: str) -> DataFrame:
    """One row per row of ``docs``: id, mark, n, component, kept."""
    bands = bands_for(percent / 100)
    source = docs.select(
        F.col(key).cast("bigint").alias("id"), F.col(text).cast("binary").alias("text"), _mark(text).alias("mark")
    )
    schema = "id bigint, mark bigint, n bigint, code binary, keys array<bigint>"
    signed = materialized(source.mapInArrow(_signatures(width, bands), schema))
    told = signed.filter("id IS NOT NULL AND n > 0")
    # Equal sets have equal keys: any row's will do.
    classes = told.groupBy("code").agg(F.min("id").alias("rep"), F.min(F.struct("n", "keys")).alias("r"))
    classes = classes.select("code", "rep", "r.*", F.monotonically_increasing_id().alias("id"))
    classes = materialized(classes)
    spread = classes.select("id", F.explode("keys").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1").select("bucket")
    buckets = materialized(spread.join(shared, "bucket"))

    wanted = materialized(classes.select("id", "rep", "code").join(buckets.select("id").distinct(), "id", "left_semi"))
    holders = wanted.select(F.col("rep").alias("id")).distinct().hint("shuffle_hash")
    texts = source.select("id", "text").join(holders, "id", "left_semi")
    sets = texts.mapInArrow(_sets(width), "id bigint, code binary, shingles array<bigint>")
    # The code tells the texts of a key apart; equal ones count once.
    sets = sets.withColumnRenamed("id", "rep").join(wanted, ["rep", "code"])
    sets = materialized(sets.groupBy("id").agg(F.first("shingles").alias("shingles")))

    # What a set shares with any other candidate bounds its similarity to all of them.
    held = sets.select("id", F.explode("shingles").alias("shingle")).groupBy("shingle")
    alone = held.agg(F.count("*").alias("m"), F.min("id").alias("id")).filter("m = 1")
    alone = alone.groupBy("id").agg(F.count("*").alias("own"))
    able = sets.select("id", F.size("shingles").cast("bigint").alias("n")).join(alone, "id", "left")
    able = able.select("id", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("c"))
    able = able.filter(f"100 * c >= {percent} * n")

    live = buckets.join(able, "id")
    rank = F.struct((F.col("c") / F.col("n")).alias("part"), (-F.col("id")).alias("id"), "n", "c")
    best = live.groupBy("bucket").agg(F.max(rank).alias("best"), F.count("*").alias("m")).filter("m > 1")
    best = best.select("bucket", (-F.col("best.id")).alias("centre"), F.col("best.n").alias("centre_n"),
                       F.col("best.c").alias("centre_c"))
    live = materialized(live.join(best, "bucket"))

    def possible(n: str, c: str, other_n: str, other_c: str) -> Column:
        return F.expr(f"(100 + {percent}) * least({c}, {other_c}) >= {percent} * ({n} + {other_n})")

    star = live.filter((F.col("id") != F.col("centre")) & possible("n", "c", "centre_n", "centre_c"))
    pairs = star.select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct()
    tested = materialized(_compared(pairs, sets))
    links = tested.filter(_linked(percent)).select(F.col("a").alias("u"), F.col("b").alias("v"))
    roots = materialized(components(links))

    # Buckets with several components: those outside the largest against all they may be linked to.
    far = tested.select(
        F.col("a").alias("id"), F.col("b").alias("centre"),
        (1 - F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("far"),
    )
    named = live.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    sizes = named.groupBy("bucket", "root").agg(F.count("*").alias("m"))
    largest = sizes.groupBy("bucket").agg(
        F.max(F.struct("m", "root")).alias("l"), F.count("*").alias("k"), F.sum("m").alias("size")
    )
    largest = largest.filter("k > 1").select("bucket", F.col("l.root").alias("main"), "size")
    named = named.join(largest, "bucket").join(far, ["id", "centre"], "left")
    ratio = -math.log(percent / 100)
    named = materialized(
        named.filter("id <> centre").select(
            "bucket", "id", "n", "c", "root", "main", "far", "size", F.floor(F.log("n") / ratio).alias("scale")
        )
    )
    few = named.filter(F.col("size") <= FEW)
    near = few.withColumn("scale", F.explode(F.expr("array(scale - 1, scale, scale + 1)")))
    x, y = few.filter("root <> main").alias("x"), near.alias("y")
    apart = F.abs(F.col("x.far") - F.col("y.far"))
    left_open = (
        (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.scale") == F.col("y.scale"))
        & (F.col("x.root") != F.col("y.root"))
        & ((F.col("y.root") == F.col("y.main")) | (F.col("x.id") < F.col("y.id")))
        & possible("x.n", "x.c", "y.n", "y.c")
        & F.coalesce(apart <= 1 - percent / 100 + 1e-9, F.lit(True))
    )
    pairs = x.join(y, left_open).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    many = named.filter(F.col("size") > FEW).groupBy("id").agg(
        F.first("n").alias("n"), F.first("root").alias("root"), F.max(F.col("root") != F.col("main")).alias("outside")
    )
    pairs = pairs.union(_rare_pairs(many, sets, percent))
    last = materialized(_compared(pairs.distinct(), sets).filter(_linked(percent)))
    found = roots if last.isEmpty() else components(links.union(last.select("a", "b")))

    # Of a component the row of its smallest key stays; of two texts of that key, one.
    named = found.join(classes.select("id", "rep"), "id")
    least = named.groupBy("root").agg(F.min(F.struct("rep", "id")).alias("least"))
    named = named.join(least, "root").select("id", F.col("least.rep").alias("component"), F.col("least.id").alias("stays"))
    named = classes.select("id", "code", "rep").join(named, "id", "left").select(
        "code", F.coalesce("component", "rep").alias("component"), (F.coalesce("stays", "id") == F.col("id")).alias("_stays")
    )
    rows = signed.select("id", "mark", "n", "code").join(named, "code", "left")
    component = F.coalesce("component", "id")
    kept = F.col("id").isNull() | ((F.col("id") == component) & F.coalesce("_stays", F.lit(True)))
    return rows.select("id", "mark", "n", component.alias("component"), kept.alias("kept"))


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per row of ``docs``: the key, ``n_shingles``, ``component_id``, ``kept``.

    Texts whose shingle sets have at least ``percent`` of their union in common are linked;
    ``component_id`` is the smallest key reachable over links, ``kept`` whether the row's text
    is the one that stays of its component, which is of that key. Null and empty texts have no
    shingles and no links. Equal rows are one document. The texts of a key with several are
    compared and judged one by one. A null key is in no component and is kept. No rows give
    no rows; other columns are ignored.
    """
    rows = _judged(docs, width, percent, text, key)
    return rows.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept"
    )


def drop_near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """The rows of ``docs``, all columns, that ``near_duplicates`` keeps: all without words or without a
    key, and repeated rows all or none. No rows give no rows."""
    judged = _judged(docs, width, percent, text, key).filter("NOT kept")
    gone = materialized(judged.select(F.col("id").alias("_gone"), F.col("mark").alias("_text")).distinct())
    gone = broadcast_if_small(gone)
    rows = docs.select(whole_row(docs), F.col(key).cast("bigint").alias("_id"), _mark(text).alias("_mark"))
    same = (F.col("_id") == F.col("_gone")) & (F.col("_mark") == F.col("_text"))
    return rows.join(gone, same, "left_anti").select("_row.*")
