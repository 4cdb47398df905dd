import random
from collections import defaultdict

import numpy as np
import pytest

from termshard.llm import hard_negatives as hn

ROWS = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every, positives=5, negatives=10):
    """rows (id, label, list of ints) against the anchors, by sorting all scores."""
    out = []
    anchors = {}
    for r in rows:
        if r[0] % every == 0:
            anchors[r[0]] = min(anchors.get(r[0], r), r)
    for a, label, v in anchors.values():
        scored = [(-sum(x * y for x, y in zip(v, w)), i, own) for i, own, w in rows if len(w) == len(v)]
        same = sorted((s, i) for s, i, own in scored if own == label and i != a)[:positives]
        for p, positive in same:
            fits = sorted((s, i) for s, i, own in scored if own != label and 30 * -p <= 100 * -s <= 90 * -p)
            out += [(a, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def made(n, size, labels, seed, spread=20):
    rng = random.Random(seed)
    return [(i, rng.randrange(labels), [rng.randrange(-spread, spread + 1) for _ in range(size)]) for i in range(n)]


def searched(spark, rows, every=10, parts=3, **options):
    table = spark.createDataFrame(rows, "id bigint, label bigint, v array<bigint>").repartition(parts)
    return sorted(map(tuple, hn.hard_negatives(table, table.filter(hn.anchors_of(every, "id")), **options).collect()))


@pytest.mark.parametrize(("size", "spread"), [(1, 3), (2, 4), (8, 20), (64, 300)])
def test_equal_to_sorting_all_scores(spark, monkeypatch, size, spread):
    """Many ties, zero vectors, one dimension, and many; blocks smaller than the tasks' rows."""
    monkeypatch.setattr(hn, "BLOCK_ROWS", 100)
    monkeypatch.setattr(hn, "FIRST_DEPTH", 4)
    rows = made(600, size, 4, size, spread) + [(i, i % 3, [0] * size) for i in range(600, 640)]
    got = searched(spark, rows)
    assert got == brute(rows, 10) and (got or size == 1)


def test_a_very_common_vector_and_few_rows(spark):
    common = made(1, 6, 1, 3)[0][2]
    rows = [(i, i % 5 == 0, common) for i in range(400)] + made(40, 6, 3, 4)[1:]
    rows = [(i, int(label), v) for i, (_, label, v) in enumerate(rows)]
    assert searched(spark, rows) == brute(rows, 10)
    for n in (0, 1, 2, 12):
        few = made(n, 5, 2, n)
        assert searched(spark, few, every=3) == brute(few, 3)


def test_repeated_rows_and_vectors_of_two_lengths(spark):
    rows = made(200, 4, 3, 5) + made(100, 7, 3, 6) + made(60, 4, 3, 7)
    assert searched(spark, rows) == brute(rows, 10)


def test_anchors_in_several_groups(spark, monkeypatch):
    monkeypatch.setattr(hn, "GROUP_BYTES", 3_000)
    rows = made(300, 8, 3, 8)
    assert searched(spark, rows, every=7) == brute(rows, 7)


def test_large_components_stay_exact(spark):
    rows = [(i, label, [x * 5 * 10**7 for x in v]) for i, label, v in made(120, 3, 2, 9)]
    assert searched(spark, rows) == brute(rows, 10)
    with pytest.raises(ValueError, match="bigint"):
        searched(spark, [(i, 0, [2**40]) for i in range(20)])


def test_reading_ends_before_the_lists_do():
    """Where one list decides, far fewer rows are met than there are."""
    rng = np.random.default_rng(1)
    matrix = np.c_[rng.integers(-1000, 1000, 5000), rng.integers(-3, 4, 5000)].astype(float)
    lists, met = hn.Lists(np.arange(5000), matrix), []
    window = hn.Kept(10)
    offer = window.offer
    window.offer = lambda ids, scores: (met.append(len(ids)), offer(ids, scores))
    lists.best(np.array([50.0, 1.0]), np.ones(5000, bool), [window])
    want = np.lexsort((np.arange(5000), -(matrix @ [50.0, 1.0])))[:10]
    assert window.ids.tolist() == want.tolist() and sum(met) < 500


def test_rows_that_take_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, -0.1], 3), (2, None, 3), (3, [0.1, None], 3), (4, [nan, 0.0], 3), (5, [0.0, -inf], 3), (6, [0.5], None),
            (None, [0.5], 1), (7, [], 1), (8, [0.00390625, -0.00390625], 0)]
    got = hn.quantised(spark.createDataFrame(rows, ROWS)).collect()
    assert sorted(map(tuple, got)) == [(1, 3, [25, -26]), (7, 1, []), (8, 0, [1, -1])]


def test_windows_of_a_negative_positive(spark):
    """Below a positive of no or negative score there is no window, or only that of 0."""
    rows = [(0, 0, [1, 0]), (1, 0, [-5, 0]), (2, 0, [0, 3]), (3, 1, [0, 1]), (4, 1, [-4, 0]), (5, 1, [3, 0])]
    got = defaultdict(list)
    for anchor, positive, _, negative, *_ in searched(spark, rows):
        got[anchor, positive].append(negative)
    assert got == {(0, 2): [3]}
