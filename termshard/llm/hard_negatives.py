"""Hard negatives of anchors by Fagin's threshold algorithm.

A block of rows keeps, for every dimension, the list of its rows sorted by their component. For an
anchor a list is read from the end that its component's sign makes largest, all lists to the same
depth; rows met are scored by their whole vectors. No row that was not met can score above the
threshold, the sum of what the lists stand at. Reading ends once the threshold is strictly below
the score that a row needs: below the k-th best of every window, or below the window itself.

Anchors are a stated set of queries. They go to the tasks in groups of a bounded size; every task
answers them for its own rows, block by block, keeping the best of each window, and the best of all
tasks are united by a shuffle that sees a few rows an anchor and task. The first pass finds an
anchor's positives, which make the windows of the second.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termshard.llm.common import materialized

BLOCK_ROWS = 16_384
GROUP_BYTES = 32 << 20
FIRST_DEPTH = 32
EXACT = 1 << 53
FOUND = "anchor_id bigint, window int, id bigint, score bigint"


def anchors_of(every: int, key: str = "vec_id") -> Column:
    return F.coalesce(F.col(key) % every == 0, F.lit(False))


def quantised(
    rows: DataFrame, scale: int = 256, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``id``, ``label`` and ``v``, the vector's components times ``scale`` rounded down, of the rows
    that take part: those with a key, a label, and a vector whose components are all finite."""
    v = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))
    finite = F.forall(F.col(vector), lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    known = F.col(key).isNotNull() & F.col(label).isNotNull() & finite
    own = rows.filter(known).select(
        F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), v.alias("v")
    )
    return own


class Lists:
    """Rows of one dimension with their sorted lists. ``matrix`` holds integers, as floats where
    these are exact."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix = ids, matrix
        self.order = np.argsort(matrix, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.take_along_axis(matrix, self.order.T, axis=0).T

    def best(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[Kept]) -> None:
        """Offers the rows that ``allowed`` marks to the windows until none can take another."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met = np.zeros(n, bool)
        depth = 0
        live = [w for w in windows if w.low <= w.high]
        while live and depth < n:
            to = min(n, max(FIRST_DEPTH, 2 * depth))
            fresh = np.zeros(n, bool)
            # With a zero vector nothing is sorted: every row scores 0.
            fresh[self.order[up, n - to : n - depth]] = True
            fresh[self.order[down, depth:to]] = True
            if not len(up) + len(down):
                fresh[depth:to] = True
            fresh &= ~met
            met |= fresh
            depth = to
            seen = np.flatnonzero(fresh & allowed)
            scores = (self.matrix[seen] @ anchor).astype(np.int64)
            for w in live:
                w.offer(self.ids[seen], scores)
            threshold = anchor[up] @ self.sorted[up, n - depth] + anchor[down] @ self.sorted[down, depth - 1]
            live = [w for w in live if threshold >= w.needed()]


@dataclass
class Kept:
    """The best ``count`` rows with a score from ``low`` to ``high``: higher scores first, then
    smaller ids. A window that no score limits is open: its ``low`` is -inf."""

    count: int
    low: float = -np.inf
    high: float = np.inf
    ids: np.ndarray | None = None
    scores: np.ndarray | None = None

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        inside = (scores >= self.low) & (scores <= self.high)
        ids, scores = ids[inside], scores[inside]
        if self.ids is not None:
            ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        first = np.lexsort((ids, -scores))[: self.count]
        self.ids, self.scores = ids[first], scores[first]

    def needed(self) -> float:
        """The least score that can still change the window."""
        full = self.ids is not None and len(self.ids) == self.count
        return max(self.low, self.scores[-1]) if full else self.low


@dataclass
class Anchor:
    id: int
    label: int
    vector: np.ndarray
    windows: list[tuple[int, float, float]]  # number, least and largest score


def _searched(rows: DataFrame, anchors: list[Anchor], count: int, same_label: bool, exact: type) -> DataFrame:
    """The best ``count`` rows of each task for each window of ``anchors``."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                if n + part.num_rows > BLOCK_ROWS:
                    yield pa.Table.from_batches(held)
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if held:
            yield pa.Table.from_batches(held)

    def sized(block: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """A block's rows by the length of their vectors."""
        ids, labels = (block[c].to_numpy() for c in ("id", "label"))
        v = block["v"].combine_chunks()
        bounds, flat = v.offsets.to_numpy(), v.values.to_numpy()
        sizes = np.diff(bounds)
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            matrix = flat[bounds[own][:, None] + np.arange(size)].astype(exact)
            yield size, ids[own], labels[own], matrix

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        kept = [[Kept(count, low, high) for _, low, high in a.windows] for a in asked]
        for block in blocks(batches):
            for size, ids, labels, matrix in sized(block):
                whole = None if same_label else Lists(ids, matrix)
                of_label = {}
                for a, windows in zip(asked, kept):
                    if len(a.vector) != size:
                        continue
                    lists = whole
                    if same_label:
                        if a.label not in of_label:
                            own = labels == a.label
                            of_label[a.label] = Lists(ids[own], matrix[own])
                        lists = of_label[a.label]
                        allowed = lists.ids != a.id
                    else:
                        allowed = labels != a.label
                    lists.best(a.vector.astype(exact), allowed, windows)
        for a, windows in zip(asked, kept):
            found = [(n, k) for (n, _, _), k in zip(a.windows, windows) if k.ids is not None and len(k.ids)]
            if found:
                ids, scores = (np.concatenate([getattr(k, c) for _, k in found]) for c in ("ids", "scores"))
                numbers = np.repeat(np.array([n for n, _ in found], np.int32), [len(k.ids) for _, k in found])
                columns = [np.full(len(ids), a.id), numbers, ids, scores]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["anchor_id", "window", "id", "score"])

    return rows.mapInArrow(work, FOUND)


def _first(found: DataFrame, count: int) -> DataFrame:
    """The best ``count`` of all tasks, numbered from 1."""
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def _groups(anchors: DataFrame) -> Iterator[DataFrame]:
    """The anchors, once each, in groups whose vectors are at most about GROUP_BYTES."""
    own = anchors.groupBy("id").agg(F.min(F.struct("label", "v")).alias("a")).select("id", "a.*")
    own = materialized(own)
    size = own.agg(F.sum(8 * F.size("v").cast("bigint") + 256)).first()[0] or 0
    groups = -(-size // GROUP_BYTES)
    for g in range(groups):
        yield own.filter(F.pmod(F.xxhash64("id"), F.lit(groups)) == g)


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10,
    least: int = 30, most: int = 90,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` and ``anchors`` are tables ``(id, label, v)`` as ``quantised`` gives them. An anchor's
    positives are the ``positives`` other rows of its label with the highest inner products; for
    each the ``negatives`` best rows of other labels that score from ``least`` to ``most`` per cent
    of the positive. Ties go to the smaller id. Fewer rows give fewer results, and none gives none.
    A row with the anchor's id is never its positive; other repeated rows count as often as they
    occur. Of the anchors with one id that with the least label and vector is taken.
    Vectors of different lengths don't meet. Components so large that a product may leave the range
    of a bigint are an error.
    """
    rows = materialized(rows)
    parts = rows.sparkSession.sparkContext.defaultParallelism
    head = rows.agg(
        F.count("*").alias("n"), F.max(F.size("v")).alias("size"),
        F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))).alias("large"),
    ).first()
    bound = (head["size"] or 0) * (head["large"] or 0.0) ** 2
    if bound >= 2.0**63:
        raise ValueError("inner products may leave the range of a bigint")
    exact = np.float64 if bound < EXACT else np.int64
    # Small files make small blocks: fewer tasks are as good, where each has a block to work on.
    tasks = max(parts, -(-head["n"] // BLOCK_ROWS))
    rows = rows.coalesce(tasks)
    parts_found = []
    for group in _groups(anchors):
        asked = [
            Anchor(r["id"], r["label"], np.array(r["v"], np.int64), [(0, -np.inf, np.inf)]) for r in group.collect()
        ]
        best = _first(_searched(rows, asked, positives, True, exact), positives)
        best = materialized(best.select("anchor_id", F.col("rank").alias("window"), "id", "score"))
        of = {a.id: a for a in asked}
        for a in asked:
            a.windows = []
        for r in best.orderBy("anchor_id", "window").collect():
            low, high = -(-least * r["score"] // 100), most * r["score"] // 100
            of[r["anchor_id"]].windows.append((r["window"], low, high))
        found = _first(_searched(rows, [a for a in asked if a.windows], negatives, False, exact), negatives)
        found = found.select("anchor_id", "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        named = best.select("anchor_id", "window", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        parts_found.append(materialized(found.join(named, ["anchor_id", "window"])))
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    if not parts_found:
        empty = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return rows.sparkSession.createDataFrame([], empty)
    result = parts_found[0]
    for part in parts_found[1:]:
        result = result.unionByName(part)
    return result.select(*columns)
