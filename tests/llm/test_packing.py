import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termshard.llm import packing, range_coder, token_files
from termshard.llm.common import scratch_path
from termshard.llm.encoding import Encoder, byte_slices, default_path

ODD_TEXTS = [
    "", " ", " a\nb ", "it's don't WE'LL x'S\u00a0NBSP\u2003y  \t z", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>",
    "ΑΣ ΣΑΣ. İstanbul é ñ 12ab3 ½ ² ªº", "日本語 テスト 😀😀 a😀b", "a\x1cb \x85c", "Ǆ ǅ ß ẞ", "...!!! a.b,c d., e!\" f. g, h.\ni",
    "A\u0300 a\u0300 \u1e01\u0307", "_a_ __ a_b", "\u0345 x\u0345", "ABC. DEF, \n\n G",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_path())


def encoded(tokenizer, text, end):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_ids_are_the_librarys(tokenizer, sample):
    texts = ODD_TEXTS + [None] + [r["text"] for r in sample.limit(40).collect()]
    got = []
    for flat, bounds in Encoder(default_path(), words=50, parts=20).encode(pa.array(texts)):
        got += [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    assert got == [encoded(tokenizer, t, 0)[:-1].tolist() for t in texts]


@pytest.mark.parametrize("texts", [[""], [None, "", None], [" ", "\n\n"], ["\u3000"], ["", "a b", None, "c"]])
def test_texts_without_ids(tokenizer, texts):
    own = Encoder(default_path(), words=50, parts=20)
    for part in (pa.array(texts), pa.array(["zz", *texts]).slice(1)):
        [(flat, bounds)] = own.encode(part)
        got = [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        assert flat.dtype == np.uint32 and got == [encoded(tokenizer, t, 0)[:-1].tolist() for t in texts]


def test_slices_cover_the_texts():
    texts = pa.array(["a" * n for n in (5, 0, 30, 1, 1, 1, 9)] + [None])
    for size in (1, 7, 1000):
        parts = [x for s in byte_slices(texts.slice(1), size) for x in s.to_pylist()]
        assert parts == ["", "a" * 30, "a", "a", "a", "a" * 9, ""]


@pytest.mark.parametrize("table", ["sample", "odd"])
def test_packed_documents(request, tokenizer, table):
    docs = request.getfixturevalue(table)
    rows = packing.pack_documents(docs, 512).toPandas()
    want = []
    for r in docs.collect():
        ids = encoded(tokenizer, r["text"], 0)
        want += [(r["doc_id"], i, at, len(ids[at : at + 512]), zlib.crc32(ids[at : at + 512])) for i, at in enumerate(range(0, len(ids), 512))]
    got = rows[["doc_id", "piece", "start", "length", "ids_crc32"]].astype(object).where(rows.doc_id.notna(), None)
    columns = ["piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, rows[columns].values.tolist())) == sorted(w[1:] for w in want)
    assert got.doc_id.dropna().astype(int).value_counts().to_dict() == {
        d: sum(w[0] == d for w in want) for d in {w[0] for w in want} - {None}
    }
    for _, bin_ in rows.groupby("sequence_id"):
        bin_ = bin_.sort_values("offset")
        assert bin_.offset.tolist() == [0, *bin_.length.cumsum()[:-1]] and bin_.length.sum() <= 512
    assert rows.sequence_id.nunique() <= 1.03 * rows.length.sum() / 512 + 1


@pytest.mark.parametrize("table", ["sample", "odd"])
def test_sequences_hold_the_ids_of_the_texts(request, spark, tokenizer, table):
    docs, folder = request.getfixturevalue(table), scratch_path(spark, "sequences")
    digest = packing.pack_documents(docs, 512, to=folder).collect()
    written = spark.read.parquet(folder).collect()
    got, spans = [], []
    for s in written:
        ids = np.frombuffer(s["ids"], "<u2").astype("<u4")
        assert len(ids) == s["length"] <= 512 and sum(p["length"] for p in s["pieces"]) == s["length"]
        for p in s["pieces"]:
            part = ids[p["offset"] : p["offset"] + p["length"]]
            got.append((p["doc_id"], p["piece"], part.tolist()))
            spans.append((p["doc_id"], p["piece"], p["start"], p["length"], zlib.crc32(part), s["sequence_id"], p["offset"]))
    want = []
    for r in docs.collect():
        ids = encoded(tokenizer, r["text"], 0).tolist()
        want += [(r["doc_id"], i, ids[at : at + 512]) for i, at in enumerate(range(0, len(ids), 512))]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sorted(spans, key=repr) == sorted(map(tuple, digest), key=repr)
    assert len({s["sequence_id"] for s in written}) == len(written)


def test_every_capacity_holds():
    lengths = np.random.default_rng(4).integers(1, 100, 800)
    for rule in ("norm", "dot"):
        for documents, attention in ((3, 100**2), (100, 3000), (100, 100**2)):
            bins, offsets = packing.best_fit(lengths, 100, documents, attention, rule=rule)
            for b in set(bins):
                own = lengths[bins == b]
                assert own.sum() <= 100 and len(own) <= documents
                assert np.square(own).sum() <= attention or len(own) == 1
                assert sorted(offsets[bins == b]) == [0, *np.cumsum(own[np.argsort(offsets[bins == b])])[:-1]]
    bins, _ = packing.best_fit(lengths, 100, 100, 100**2)
    assert len(set(bins)) <= 1.05 * lengths.sum() / 100 + 1


def test_no_documents(none):
    assert packing.pack_documents(none).count() == 0


def test_blocks_come_back():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 511, 513, 3000, 30_000):
        for ids in (rng.integers(0, 65536, n), np.zeros(n, int), rng.zipf(1.3, n) % 5000):
            ids = ids.astype(np.uint32)
            assert (range_coder.decode_block(range_coder.encode_block(ids)) == ids).all()


def test_contexts_shorten_the_code():
    rng = np.random.default_rng(6)
    words = [rng.integers(0, 5000, 8) for _ in range(50)]
    ids = np.concatenate([words[i] for i in rng.integers(0, 50, 20_000)]).astype(np.uint32)
    assert 8 * len(range_coder.encode_block(ids)) / len(ids) < 2.5  # order 0 alone needs over 8


def test_carries_go_into_earlier_words(monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(range_coder, "LANE_IDS", 64)
    for top in (3, 300, 65536):
        for ids in (rng.integers(0, top, 200_001), (rng.zipf(1.2, 200_001) % top)):
            ids = ids.astype(np.uint32)
            ids[-1] = top - 1
            assert (range_coder.decode_block(range_coder.encode_block(ids)) == ids).all()


def test_a_step_makes_few_calls():
    """All lanes move on by one id in a step; the time of a block goes with the calls of a step."""
    ids = (np.random.default_rng(8).zipf(1.3, 64 * 512) % 5000).astype(np.uint32)
    block, calls = range_coder.encode_block(ids), []
    for f, given in ((range_coder.encode_block, ids), (range_coder.decode_block, block)):
        calls.clear()
        sys.setprofile(lambda frame, event, arg: calls.append(event))
        try:
            f(given)
        finally:
            sys.setprofile(None)
        assert (calls.count("call") + calls.count("c_call")) / 512 < 95  # 110 and 122 with two renewals


def test_damage_is_found():
    block = bytearray(range_coder.encode_block(np.arange(5000, dtype=np.uint32)))
    for at in (1, 9, 40, len(block) - 1):
        bad = bytearray(block)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            range_coder.decode_block(bytes(bad))
    with pytest.raises(ValueError):
        range_coder.encode_block(np.array([70_000], np.uint32))


@pytest.mark.parametrize("table", ["sample", "odd"])
def test_token_files(request, spark, tokenizer, monkeypatch, table):
    docs = request.getfixturevalue(table)
    folder = scratch_path(spark, "tokens")
    token_files.write_tokens(docs.repartition(3), folder)
    got = token_files.read_tokens(spark, folder).collect()
    ids = {}
    for r in docs.collect():
        ids.setdefault(r["doc_id"], []).append(encoded(tokenizer, r["text"], 1))
    want, at = [], 0
    rows = sorted(got, key=lambda r: r["start"])
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    keys = [r["doc_id"] for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    count = lambda pairs: sorted(pairs, key=repr)
    want = [(d, len(x), zlib.crc32(x)) for d, xs in ids.items() for x in xs]
    assert count((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == count(want)
    stored = spark.read.parquet(folder)
    assert stored.select(F.sum("n_ids")).first()[0] == at


def test_token_files_of_nothing(spark, none):
    folder = scratch_path(spark, "tokens")
    token_files.write_tokens(none, folder)
    assert token_files.read_tokens(spark, folder).count() == 0
