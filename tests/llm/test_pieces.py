import random

import pyarrow as pa
import pytest

from termshard.llm import sentence_pieces as sp

PARTS = ["a", "b", "the", "▁", " ", "  ", "\n", "\t", "é", "😀", "\x00", "一", "<s>", "</s>", "<unk>", "<0x41>", "　", "\xa0", "1", "."]


@pytest.fixture(scope="module")
def library():
    return sp.pieces_of(sp.default_path()).library


def test_chunks_are_segmented_as_whole_texts_are(library):
    """Every run of blanks, markers in the text, blanks at both ends, empty texts."""
    rng, own = random.Random(5), sp.pieces_of(sp.default_path())
    for _ in range(60):
        texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(14))) for _ in range(25)]
        distinct, which, bounds = sp.chunks_of(pa.array(texts, pa.large_string()))
        ids = own.segment(distinct)
        got = [[i for c in which[a:b] for i in ids[c]] for a, b in zip(bounds[:-1], bounds[1:])]
        assert got == library.encode(texts)
        assert [own.text(i) for i in got] == [library.decode(i) for i in got]


def test_any_ids_are_decoded_as_the_library_does(library):
    rng, own = random.Random(6), sp.pieces_of(sp.default_path())
    for _ in range(2000):
        ids = [rng.choice([0, 1, 2, 3, 200, 258, 259, own.marker, rng.randrange(32000)]) for _ in range(rng.randrange(9))]
        assert own.text(ids) == library.decode(ids)


@pytest.mark.parametrize("table", ["sample", "odd"])
def test_whole_texts_and_back(request, library, table):
    docs = request.getfixturevalue(table)
    want = sorted(((r["doc_id"], library.encode(r["text"] or "") + [2], library.decode(library.encode(r["text"] or ""))) for r in docs.collect()), key=repr)
    rows = sp.decoded(sp.encoded(docs))
    assert rows.columns == ["doc_id", "ids", "text"]
    assert sorted(map(tuple, rows.collect()), key=repr) == want
    assert sp.encoded(docs.limit(0)).count() == 0
    assert [r["ids"][-1:] == [2] for r in sp.encoded(docs, end=False).limit(3).collect()] == [False] * 3


@pytest.mark.parametrize(("chunks", "size"), [(10**6, 10**9), (20, 10**9), (10**6, 50)])
def test_a_chunk_is_segmented_once_while_the_table_lasts(library, chunks, size):
    rng, own, asked = random.Random(7), sp.pieces_of(sp.default_path()), []
    table = sp.ChunkTable(lambda new: (asked.extend(new), own.segment(new))[1], chunks, size)
    for _ in range(40):
        texts = [" ".join(f"word{rng.randrange(60)}" for _ in range(rng.randrange(20))) for _ in range(5)]
        flat, bounds = table.encode(pa.array(texts, pa.large_string()))
        got = [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        assert got == library.encode(texts)
        assert len(table.row) <= chunks + 100
    assert (len(asked) == len(set(asked))) == (chunks > 20 and size > 50)


def test_a_model_that_changes_blanks_is_refused(monkeypatch):
    class Changed:
        def __init__(self, model_file):
            self.pieces = ["<unk>", "▁a", "a▁b"]

        id_to_piece = lambda self, i: self.pieces[i]
        get_piece_size = lambda self: 3

    monkeypatch.setattr(sp.sentencepiece, "SentencePieceProcessor", Changed)
    with pytest.raises(ValueError, match="cross blanks"):
        sp.Pieces("any")


def test_no_ids_are_the_empty_text(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [2])], "doc_id bigint, ids array<int>")
    assert {r["text"] for r in sp.decoded(rows).collect()} == {""}
