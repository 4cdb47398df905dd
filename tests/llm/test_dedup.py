import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from brute import lowered, near_components, shingle_sets

from termshard.llm import content_sort, minhash
from termshard.llm.components import components


def by_key(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["doc_id"]].append(r)
    return out


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("table", ["sample", "odd"])
def test_content_groups(request, table, keep):
    docs = request.getfixturevalue(table)
    groups = defaultdict(list)
    for r in docs.collect():
        groups[lowered(r["text"])].append(r["doc_id"])
    pick = max if keep == "largest" else min
    got = content_sort.content_groups(docs, keep=keep).collect()
    want = []
    for norm, ids in groups.items():
        best = pick((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(norm.encode()).hexdigest()
        left = True
        for i in ids:
            kept = left and i == best
            left &= not kept
            want.append((i, best, len(ids), kept, sha))
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    assert order(got) == order(want)


def test_a_text_of_many_rows_is_dealt_and_united(spark):
    rng = random.Random(1)
    rows = [(i, "Same text" if i % 2 else "same TEXT") for i in range(3000)]
    rows += [(i, f"text {rng.randrange(900)}") for i in range(3000, 4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    frequent = content_sort.frequent_contents(docs.selectExpr("hash(lower(text)) AS _hash"), 4000, 250)
    assert [parts for _, parts in frequent] == [12]
    got = by_key(content_sort.content_groups(docs, keep="largest").collect())
    assert {got[i][0]["keep_id"] for i in range(3000)} == {2999}
    assert {got[i][0]["group_size"] for i in range(3000)} == {3000}
    assert [i for i in range(3000) if got[i][0]["kept"]] == [2999]
    kept = content_sort.drop_copies(docs).collect()
    assert len(kept) == len({t.lower() for _, t in rows}) and 0 in {r["doc_id"] for r in kept}


def test_no_second_exchange_of_the_texts(sample):
    plan = content_sort.content_groups(sample)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_dropping_keeps_all_columns(odd, none):
    kept = content_sort.drop_copies(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({lowered(r["text"]) for r in odd.collect()})
    assert content_sort.content_groups(none).count() == content_sort.drop_copies(none).count() == 0


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(sample, width, percent):
    rows = [(r["doc_id"], r["text"]) for r in sample.collect()]
    got = minhash.near_duplicates(sample, width, percent).collect()
    want = near_components(rows, width, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_chains_and_a_large_group(spark):
    """Copies of one text that all differ, chains of small steps, and texts just too different."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for doc in range(150):
        text = list(base)
        for _ in range(rng.randrange(0, 9)):
            text[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((doc, " ".join(text)))
    chain = [f"c{i}" for i in range(60)]
    for doc in range(200, 230):
        chain[(doc * 7) % 60] = f"y{doc}"
        rows.append((doc, " ".join(chain)))
    rows += [(300 + i, f"short text {i % 3}") for i in range(9)] + [(400, "solo"), (401, "Solo"), (402, "a b"), (403, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs, 3, 85).collect()}
    assert got == near_components(rows, 3, 85)
    kept = minhash.drop_near_duplicates(docs, 3, 85)
    assert {r["doc_id"] for r in kept.collect()} == {d for d, (_, c) in got.items() if c == d}


def test_odd_rows_have_near_duplicates(odd, none):
    got = by_key(minhash.near_duplicates(odd, 3, 85).collect())
    assert got[1][0]["component_id"] == 1
    assert sorted(r["component_id"] for r in got[2]) == [1, 1, 2]  # the key's other text is alone
    assert got[7][0]["component_id"] == 6 and got[7][0]["n_shingles"] == 977
    assert [r["kept"] for r in got[None]] == [True, True]
    assert (got[3][0]["n_shingles"], got[3][0]["component_id"], got[3][0]["kept"]) == (0, 3, True)
    assert sum(map(len, got.values())) == odd.count()
    kept = minhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id IS NULL").count() == 2
    assert minhash.near_duplicates(none).count() == minhash.drop_near_duplicates(none).count() == 0


def test_texts_of_one_key_are_dropped_one_by_one(spark):
    """A key's text that is like no other stays though another of that key goes, and each is
    compared, also where the key is the smallest of several classes."""
    a, b, c = ([f"{x}{i}" for i in range(60)] for x in "abc")
    near = lambda words, i: " ".join([*words[:i], f"new{i}", *words[i + 1 :]])
    rows = [
        (1, " ".join(a).upper()), (2, " ".join(a)), (2, "quite another text that nothing is like"),
        (5, " ".join(b)), (5, " ".join(c)), (5, near(c, 0)), (6, near(b, 0)), (7, near(c, 59)), (8, " ".join(c)),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = minhash.near_duplicates(docs, 3, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] > 5} == {6: 5, 7: 5, 8: 5}
    kept = [tuple(r) for r in minhash.drop_near_duplicates(docs, 3, 85).collect()]
    of = lambda words: [t for _, t in kept if len(set(t.lower().split()) & set(words)) > 50]
    assert rows[2] in kept and of(a) == [rows[0][1]] and of(b) == [rows[3][1]]
    assert len(of(c)) == 1 and len(kept) == 4 and sum(r["kept"] for r in got) == 4


def test_borrowed_bins_agree_with_similarity():
    """Over many pairs of a given similarity, the share of equal bins is that similarity, also for
    sets with fewer shingles than bins."""
    rng = np.random.default_rng(3)
    for size in (12, 60, 900):
        same = []
        for _ in range(200):
            both = rng.integers(0, 2**63, size, dtype=np.uint64)
            one, two = (np.unique(np.r_[both, rng.integers(0, 2**63, size // 6, dtype=np.uint64)] << np.uint64(1)) for _ in "ab")
            same.append((minhash.signature(one, 288) == minhash.signature(two, 288)).mean())
        assert abs(np.mean(same) - size / (size + 2 * (size // 6))) < 0.03


def test_shingles_equal_brute_force(odd_rows):
    for doc, text, *_ in odd_rows:
        want = shingle_sets([(doc, text)], 3)[doc]
        assert len(minhash.shingles(None if text is None else text.encode(), 3)) == len(want)


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(100, 180)] + [(5, 3), (3, 5), (9, 9), (7, 3), (300, 2)]
    got = components(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    want = {i: 100 for i in range(100, 181)} | {5: 3, 7: 3, 3: 3, 300: 2, 2: 2}
    assert dict(map(tuple, got)) == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
