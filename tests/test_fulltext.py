import re
from collections import Counter
from math import log

import pytest

from termshard.functions.tokens import ENGLISH_STOP_WORDS
from termshard.operators import fulltext, patterns
from termshard.operators.bounds import listed


@pytest.fixture(scope="module")
def index(corpus_df):
    return fulltext.text_index(corpus_df)


def kept(tokens):
    return [t for t in tokens if len(t) > 1 and t not in ENGLISH_STOP_WORDS]


def weights(corpus):
    """BM25 of every (theme, doc, term)."""
    docs = {(t, d): kept(words) for t, d, words in corpus}
    n, length, df = Counter(), Counter(), Counter()
    for (theme, _), words in docs.items():
        n[theme] += 1
        length[theme] += len(words)
        for w in set(words):
            df[theme, w] += 1
    out = {}
    for (theme, doc), words in docs.items():
        for w, tf in Counter(words).items():
            idf = log(n[theme] / (df[theme, w] + 1)) + 1
            k = 1.2 * (0.25 + 0.75 * len(words) / (length[theme] / n[theme]))
            out[theme, doc, w] = idf * tf * 2.2 / (tf + k)
    return docs, out


def found(df):
    return {(r["theme"], r["doc_id"]): r["score"] for r in df.collect()}


def clauses(spark, *rows):
    return fulltext.clauses_table(spark, [dict(query_id=1, clause_id=i, **r) for i, r in enumerate(rows)])


def test_all_words_are_required(spark, corpus, index):
    docs, bm25 = weights(corpus)
    queries = spark.createDataFrame([(1, "Hot, w1 the W2 w1"), (2, "hot unknown"), (3, "the")],
                                    "query_id bigint, text string")
    got = fulltext.matches(fulltext.text_clauses(queries), index)
    expected = {
        key: sum(bm25[(*key, w)] for w in ("hot", "w1", "w2"))
        for key, words in docs.items() if {"hot", "w1", "w2"} <= set(words)
    }
    assert found(got) == pytest.approx(expected) and expected
    assert {r["query_id"] for r in got.collect()} == {1}
    top = fulltext.search_text(queries, index, limit=2, theme="big").collect()
    order = sorted((k for k in expected if k[0] == "big"), key=lambda k: (-round(expected[k], 9), k))
    assert [r["id"] for r in sorted(top, key=lambda r: r["rank"])] == [f"big_{d}" for _, d in order[:2]]


@pytest.mark.parametrize("limit", [3, 10_000])
def test_large_batches_shuffle_and_give_the_same(spark, index, monkeypatch, limit):
    rows = clauses(spark, dict(value="hot", occur="should"), dict(value="w1", occur="should"))
    small = found(fulltext.matches(rows, index))
    monkeypatch.setattr(fulltext, "BROADCAST_ROWS", 0)
    assert found(fulltext.matches(rows, index, limit=limit)) == pytest.approx(small)


def test_or_not_and_boost(spark, corpus, index):
    docs, bm25 = weights(corpus)
    got = fulltext.matches(
        clauses(
            spark, dict(value="w1", occur="should", boost=3.0), dict(value="w2", occur="should"),
            dict(value="w3", occur="must_not"),
        ),
        index,
    )
    expected = {
        key: 3.0 * bm25.get((*key, "w1"), 0) + bm25.get((*key, "w2"), 0)
        for key, words in docs.items() if {"w1", "w2"} & set(words) and "w3" not in words
    }
    assert found(got) == pytest.approx(expected)
    only_not = fulltext.matches(clauses(spark, dict(value="w3", occur="must_not")), index)
    # What the library's users see: the complement, each hit with the score 1.
    assert found(only_not) == {key: 1.0 for key, words in docs.items() if "w3" not in words}


@pytest.mark.parametrize(
    "clause, test",
    [
        (dict(kind="prefix", value="w1"), lambda w: w.startswith("w1")),
        (dict(kind="wildcard", value="w?"), lambda w: re.fullmatch("w.", w)),
        (dict(kind="wildcard", value="*t"), lambda w: w.endswith("t")),
        (dict(kind="wildcard", value="w*3"), lambda w: re.fullmatch("w.*3", w)),
        (dict(kind="range", value="w2", upper="w24"), lambda w: "w2" <= w <= "w24"),
        (dict(kind="range", value="h", upper="i"), lambda w: "h" <= w <= "i"),
        (dict(kind="prefix", value="none"), lambda w: False),
    ],
)
def test_patterns_score_their_boost(spark, corpus, index, clause, test):
    docs, _ = weights(corpus)
    got = found(fulltext.matches(clauses(spark, dict(clause, boost=0.5)), index))
    assert got == {key: 0.5 for key, words in docs.items() if any(test(w) for w in words)}


def test_special_characters_of_a_wildcard_are_literal(spark):
    tokens = spark.createDataFrame(
        [("a", 1, ["c++", "cxx"]), ("a", 2, ["cx"])], "theme string, doc_id bigint, tokens array<string>"
    )
    got = fulltext.matches(clauses(spark, dict(kind="wildcard", value="c+*")), fulltext.text_index(tokens))
    assert found(got) == {("a", 1): 1.0}


def test_phrases(spark):
    rows = [
        ("a", 1, "state of the art state art".split()),
        ("a", 2, "art state".split()),
        ("a", 3, "state x art".split()),
        ("a", 4, "big art state art state".split()),
    ]
    tokens = spark.createDataFrame(rows, "theme string, doc_id bigint, tokens array<string>")
    index = fulltext.text_index(tokens)
    _, bm25 = weights(rows)
    phrase = lambda text: found(fulltext.matches(clauses(spark, dict(kind="phrase", value=text)), index))
    both = {k: bm25["a", k, "state"] + bm25["a", k, "art"] for k in (1, 2, 3, 4)}
    # One-letter and stop words take no position.
    assert phrase("State of art") == pytest.approx({("a", k): both[k] for k in (1, 3, 4)})
    assert phrase("art state art state") == pytest.approx({("a", 4): 2 * both[4]})
    assert set(phrase("big")) == {("a", 4)}


def test_phrases_with_slop(spark):
    """The tightest run of the words in their order, also of a repeated word and a long list."""
    texts = ["aa bb", "aa xx bb", "aa aa xx xx bb", "bb aa", "bb aa xx xx xx bb aa bb", "aa xx xx xx xx bb", "aa cc bb cc"]
    texts += [" ".join(["aa"] * 3000 + ["xx"] * 2 + ["bb"] * 3000)]
    rows = [("a", i, t.split()) for i, t in enumerate(texts)]
    index = fulltext.text_index(spark.createDataFrame(rows, "theme string, doc_id bigint, tokens array<string>"))

    def between(words, wanted):
        ways = [(i, i) for i, w in enumerate(words) if w == wanted[0]]
        for w in wanted[1:]:
            ways = [(a, min(j for j in range(b + 1, len(words)) if words[j] == w)) for a, b in ways if w in words[b + 1 :]]
        return min((b - a - len(wanted) + 1 for a, b in ways), default=None)

    for phrase in ("aa bb", "bb aa", "aa aa", "aa bb cc", "aa aa bb", "aa xx aa"):
        least = {i: between(t.split(), phrase.split()) for i, t in enumerate(texts)}
        for slop in (0, 1, 2, 4):
            got = fulltext.matches(clauses(spark, dict(kind="phrase", value=phrase, slop=slop)), index)
            assert {d for _, d in found(got)} == {i for i, n in least.items() if n is not None and n <= slop}


def test_phrases_make_no_row_per_position(spark, index):
    got = fulltext.matches(clauses(spark, dict(kind="phrase", value="hot w1"), dict(kind="phrase", value="w1 w2", slop=2)), index)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(positions" not in plan


GROUPS = [
    # A tree a query: occur, and a word or the clauses of a group.
    [("must", [("should", "w1"), ("should", [("must", "w2"), ("must_not", "w3")])]), ("must_not", "w4")],
    [("should", "w1"), ("should", [("must_not", "w2"), ("must_not", "hot")])],
    [("must", "w1"), ("must", [("must_not", "w2")])],
    [("must", [("must_not", "w2")]), ("should", "w5")],
    [("must_not", [("must_not", "w1"), ("must_not", [("must", "w2"), ("must", "w3")])])],
    [("must_not", [("must_not", "w1")]), ("should", "w2")],
    [("must_not", [("must", "w1"), ("must", "hot")]), ("must", [])],
    [("must", [("must", [("must", [("should", "w1"), ("should", "w2")]), ("must_not", "w3")])])],
    [("must_not", [("must_not", [("must_not", "w1")])])],
    [("should", [("must_not", [("must_not", "w6")])]), ("should", "w7")],
]


def rows_of_tree(tree, query, parent=None, rows=None):
    rows = [] if rows is None else rows
    for occur, body in tree:
        row = dict(query_id=query, clause_id=len(rows), occur=occur, parent=parent, boost=1.0 + len(rows) % 3)
        rows.append(row)
        if isinstance(body, str):
            row["value"] = body
        else:
            row["kind"] = "group"
            rows_of_tree(body, query, row["clause_id"], rows)
    return rows


def judged(tree, rows, score, parent=None):
    """Whether a document is a hit and its score, and whether anything positive was asked."""
    must, should, limits, total = [], [], [], 0.0
    for row in rows:
        if row["parent"] != parent:
            continue
        if row.get("kind") == "group":
            inner = judged(tree, rows, score, row["clause_id"])
            if inner is None:
                continue
            hit, own, positive = inner
            if not positive and row["occur"] != "should":
                limits.append(hit == (row["occur"] == "must"))
                continue
            own *= row["boost"]
        else:
            own = score(row["value"])
            hit, own = own is not None, (own or 0.0) * row["boost"]
        if row["occur"] == "must_not":
            limits.append(not hit)
            continue
        (must if row["occur"] == "must" else should).append(hit)
        total += own if hit else 0.0
    if not must and not should:
        return (all(limits), 1.0, False) if limits else None
    return all(must) and all(limits) and (bool(must) or any(should)), total, True


def test_nested_groups(spark, corpus, index):
    docs, bm25 = weights(corpus)
    rows = [row for q, tree in enumerate(GROUPS) for row in rows_of_tree(tree, q)]
    got = fulltext.matches(fulltext.clauses_table(spark, rows), index).collect()
    got = {(r["query_id"], r["theme"], r["doc_id"]): r["score"] for r in got}
    expected = {}
    for q, tree in enumerate(GROUPS):
        own = [r for r in rows if r["query_id"] == q]
        for key in docs:
            hit, score, _ = judged(tree, own, lambda w: bm25.get((*key, w)))
            if hit:
                expected[(q, *key)] = score
    assert {k[0] for k in expected} == set(range(len(GROUPS)))
    assert got == pytest.approx(expected)


def test_groups_that_belong_nowhere_are_refused(spark, index):
    circle = [dict(query_id=1, clause_id=0, kind="group", parent=1), dict(query_id=1, clause_id=1, kind="group", parent=0)]
    for rows in (circle, [dict(query_id=1, clause_id=0, value="w1", parent=7)]):
        with pytest.raises(ValueError, match="group"):
            fulltext.matches(fulltext.clauses_table(spark, rows + [dict(query_id=2, value="w1")]), index)


def test_every_document(spark, corpus, index):
    docs, bm25 = weights(corpus)
    every = dict(kind="every", boost=2.0)
    assert found(fulltext.matches(clauses(spark, every), index)) == {k: 2.0 for k in docs}
    without = fulltext.matches(clauses(spark, every, dict(value="w3", occur="must_not")), index)
    assert found(without) == {k: 2.0 for k, words in docs.items() if "w3" not in words}
    both = fulltext.matches(clauses(spark, every, dict(value="w3")), index)
    assert found(both) == pytest.approx({k: 2.0 + bm25[(*k, "w3")] for k, words in docs.items() if "w3" in words})


@pytest.mark.parametrize("limit", [1, 3, 500])
def test_the_first_documents_of_a_complement(spark, corpus, index, limit):
    """The smallest ids that aren't banned, also where most of them are, in every theme; no join
    without a key."""
    docs, _ = weights(corpus)
    rows = [dict(query_id=1, clause_id=0, value="hot", occur="must_not"),
            dict(query_id=2, clause_id=0, value="zzz", occur="must_not"),
            dict(query_id=3, clause_id=0, kind="every"), dict(query_id=4, clause_id=0, value="w1"),
            dict(query_id=4, clause_id=1, value="w2", occur="must_not")]
    hits = fulltext.search(fulltext.clauses_table(spark, rows), index, limit=limit)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    got = {}
    for r in hits.collect():
        got.setdefault((r["query_id"], r["theme"]), []).append((r["rank"], r["doc_id"]))
    for query, ban in ((1, "hot"), (2, "zzz"), (3, None)):
        for theme in {t for t, _ in docs}:
            left = sorted(d for (t, d), words in docs.items() if t == theme and ban not in words)
            assert sorted(got.get((query, theme), [])) == list(enumerate(left[:limit], 1))


def test_patterns_filter_the_stored_terms(spark, corpus_df, tmp_path):
    """Few patterns reach the scan of the table that is sorted for them as filters."""
    from termshard.sources import index_store

    index = index_store.build_text_index(corpus_df, str(tmp_path / "text"), 2)
    for value, column in (("ho*", "term"), ("*ot", "backward"), ("*o*", None), ("*ot*", "gram")):
        rows = fulltext.analysed_clauses(clauses(spark, dict(kind="wildcard", value=value)))
        terms = patterns.expand_patterns(rows, index.vocabulary, index.backward, index.grams)
        assert {r["term"] for r in terms.collect()} == {"hot"}
        plan = terms._jdf.queryExecution().executedPlan().toString()
        pushed = [line for line in plan.splitlines() if "FileScan" in line]
        told = {"term": "StringStartsWith(term,ho)", "backward": "StringStartsWith(backward,to)", "gram": "EqualTo(gram,ot)"}
        assert column is None or any(told[column] in line for line in pushed)


def test_many_patterns_give_the_same(spark, corpus, index):
    words = sorted({w for _, _, tokens in corpus for w in tokens})
    values = ["w*", "*3", "*1*", "w?", "?1*", "*", "h*t", "*o*", "w3*", "*ho*", "*hot*", "w*1*"]
    rows = [dict(query_id=i, clause_id=0, kind="wildcard", value=v) for i, v in enumerate(values)]
    rows += [dict(query_id=50, clause_id=0, kind="prefix", value="w2"), dict(query_id=51, clause_id=0, kind="prefix", value=""),
             dict(query_id=52, clause_id=0, kind="range", value="w1", upper="w15", exclude_upper=True),
             dict(query_id=53, clause_id=0, kind="range", value=None, upper="w1")]
    given = fulltext.analysed_clauses(fulltext.clauses_table(spark, rows))
    expected = {(i, w) for i, v in enumerate(values) for w in words if re.fullmatch(v.replace("*", ".*").replace("?", "."), w)}
    expected |= {(50, w) for w in words if w.startswith("w2")} | {(51, w) for w in words}
    expected |= {(52, w) for w in words if "w1" <= w < "w15"} | {(53, w) for w in words if w <= "w1"}
    for few in (64, 0):
        got = patterns.expand_patterns(given, index.vocabulary, few=few)
        assert {(r["query_id"], r["term"]) for r in got.collect()} == expected


def test_by_id_with_terms(spark, index):
    got = found(
        fulltext.matches(
            clauses(
                spark, dict(kind="id", value="big_1", occur="should", boost=2.0),
                dict(kind="id", value="small0_1", occur="should"),
                dict(kind="id", value="odd", occur="should"),
            ),
            index,
        )
    )
    assert got == {("big", 1): 2.0}


def test_positions(corpus, index):
    docs, _ = weights(corpus)
    for r in index.postings.collect():
        words = docs[r["theme"], r["doc_id"]]
        assert r["positions"] == [i for i, w in enumerate(words) if w == r["term"]]
        assert (r["tf"], r["dl"]) == (len(r["positions"]), len(words))


def test_bad_clauses_are_refused(spark, index):
    with pytest.raises(ValueError):
        clauses(spark, dict(kind="regex", value="x"))
    with pytest.raises(ValueError):
        clauses(spark, dict(value="x", occur="maybe"))
    with pytest.raises(ValueError):
        fulltext.search(clauses(spark, dict(value="x")), index, limit=0)


def test_listed_gives_up_beyond_its_limit(corpus_df):
    assert listed(corpus_df, "theme") == ["big", "small0", "small1"]
    assert listed(corpus_df, "theme", 2) is None


@pytest.mark.parametrize("limit", [1, 4, 100])
def test_impact_bounds_lose_no_hit(spark, corpus, index, limit):
    rows = [dict(query_id=q, clause_id=i, value=w, occur="should", boost=1.0 + i)
            for q in range(12) for i, w in enumerate(["hot", f"w{q}", f"w{3 * q}", "w1", "nobody"][: q % 5 + 1])]
    given = fulltext.clauses_table(spark, rows)
    hits = lambda df: sorted((r["query_id"], r["id"], r["rank"], round(r["score"], 9)) for r in df.collect())
    plain = hits(fulltext.search(given, index, limit, prune=False))
    for small in (None, False):
        assert hits(fulltext.search(given, index, limit, small=small, prune=True)) == plain


def test_impact_bounds_apply_to_plain_words_alone(spark, index):
    for other in (dict(value="w1 w2", occur="should"), dict(value="w1"), dict(value="w1", occur="must_not"),
                  dict(kind="prefix", value="w", occur="should")):
        given = clauses(spark, dict(value="hot", occur="should"), other)
        assert fulltext._can_be_best(given, index, 3, None, True) is None


def test_impact_bounds_drop_documents(spark):
    rows = [("t", i, ["common"] * 3 + (["rare"] if i % 50 == 0 else [])) for i in range(2000)]
    index = fulltext.text_index(spark.createDataFrame(rows, "theme string, doc_id bigint, tokens array<string>"))
    given = clauses(spark, dict(value="common", occur="should"), dict(value="rare", occur="should"))
    assert fulltext._can_be_best(given, index, 5, None, True).count() == 40
