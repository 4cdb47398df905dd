import random
import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from termshard.llm import filter_audit as fa

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id bigint, quality int, toxic int"


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    return len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall("[#$%&*|]", text))


def brute(docs, labels):
    """Every document through every order of the filters, one after the other."""
    good, toxic, least, rows = set(), set(), {}, []
    for doc, quality, poison in labels:
        good |= {doc} if quality == 1 and doc is not None else set()
        toxic |= {doc} if poison == 1 and doc is not None else set()
    for doc, text, _ in docs:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    for doc, text, part in docs:
        words, distinct, capitals, chars, symbols = measures(text)
        failed = [words < 200, 100 * distinct < 50 * words, 100 * capitals > 3 * chars, symbols > 0,
                  doc is not None and least[text or ""] < doc]
        rows.append((part or "", {x for x, f in zip("ABCDE", failed) if f}, doc in good, doc in toxic))
    out, shapley = {}, defaultdict(int)
    for order in map("".join, permutations("ABCDE")):
        for part in {r[0] for r in rows}:
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                removed = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                redundant = sum(f in r[1] for r in gone)
                alone = sum(r[1] == {f} for r in rows if r[0] == part)
                gone += removed
                out[part, order, step] = [len(left), len(removed), redundant, alone, sum(r[2] for r in removed), sum(r[3] for r in removed)]
                shapley[part, f] += len(removed)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def collected(df):
    assert df.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("block", [1, 7, 64, fa.BLOCK_BYTES])
def test_the_transducer_equals_regular_expressions(monkeypatch, block):
    """Also where words, characters and texts lie across blocks, and words share their beginnings."""
    monkeypatch.setattr(fa, "BLOCK_BYTES", block)
    rng = random.Random(block)
    alike = " ".join("w" * n + x for n in (7, 8, 9, 63, 64, 65, 200) for x in ("", "a", "b", "a"))
    for _ in range(30):
        texts = ["".join(rng.choice("ab AB\n\t\x1c é😀#x一|\x0b\x00") for _ in range(rng.randrange(60))) for _ in range(9)]
        texts += [None, "", alike, alike + alike]
        rng.shuffle(texts)
        assert (fa.scanned(pa.array(texts)) == np.array([measures(t) for t in texts]).T).all()


def test_equal_hashes_are_told_apart_by_bytes(monkeypatch):
    monkeypatch.setattr(fa, "mixed", lambda h: np.zeros_like(h))
    monkeypatch.setattr(fa.xxhash, "xxh3_64_intdigest", lambda data: 0)
    texts = ["a b c a ab ba ab", "a b", "x" * 70 + " " + "x" * 69 + "y " + "x" * 70]
    assert fa.scanned(pa.array(texts))[1].tolist() == [5, 2, 2]


def test_a_table_that_grows_keeps_what_it_holds():
    words = [f"word{i % 3000}" for i in range(9000)]
    text = " ".join(words).encode()
    data = np.frombuffer(text + b" " * 9, np.uint8)
    starts = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
    lengths = np.array([len(w) for w in words])
    table, fresh = fa.SpanTable(data), []
    for at in range(0, 9000, 700):
        part = slice(at, at + 700)
        fresh.append(table.insert(np.zeros(len(starts[part]), np.int64), starts[part], lengths[part]))
    fresh = np.concatenate(fresh)
    assert fresh[:3000].all() and not fresh[3000:].any() and len(table.held[0]) == 3000


def test_the_audit_equals_brute_force(spark, sample):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    docs = sample.select("doc_id", "text", "lang")
    got = collected(fa.filter_audit(sample, labels))
    assert got == brute(list(map(tuple, docs.collect())), list(map(tuple, labels.select("doc_id", "quality", "toxic").collect())))


def test_odd_rows_are_audited(spark, odd, odd_rows, none):
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, None), (None, 1, 1), (3, None, 1), (77, 1, 1), (12, 1, 1)]
    table = spark.createDataFrame(labels, LABELS)
    got = collected(fa.filter_audit(odd, table))
    assert got == brute([(r[0], r[1], r[2]) for r in odd_rows], labels)
    assert collected(fa.filter_audit(odd, table.limit(0))) == brute([(r[0], r[1], r[2]) for r in odd_rows], [])
    assert fa.filter_audit(none, table).count() == 0


def test_a_large_group_of_copies(spark):
    """Copies in two parts, some under one key, some under none; of the smallest key all rows pass E."""
    text = "word " * 300
    rows = [(i // 2, text, "xy"[i % 3 == 0]) for i in range(3000)] + [(None, text, "x")] * 50 + [(9999, "Other", None)]
    rows[0] = (0, text, "x")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(7)
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 1500, 7)]
    labels = [(d, q, int(t)) for d, q, t in labels]
    got = collected(fa.filter_audit(docs, spark.createDataFrame(labels, LABELS)))
    assert got == brute(rows, labels)
