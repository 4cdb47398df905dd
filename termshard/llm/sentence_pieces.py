"""Encoding and decoding with a sentencepiece model, through a table of distinct chunks.

The library writes blanks as a marker, puts one before the text, and merges pieces. Where no
piece crosses from another character to a marker, a text falls into chunks, each a run of
markers and what follows up to the next marker, that are segmented independently of each other.
So every task keeps a table of the distinct chunks it has met, each segmented once by the library,
and the ids of a text are rows of the table, joined back by the position of its chunks.

Nothing is shuffled, and a lost task is done anew from its own rows. (One table for the whole corpus
would have to be joined to every text: most distinct chunks are rare, so that moves the texts and
several times as much besides.) The table has a bound; where it is reached, a new one is begun.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termshard.llm.encoding import byte_slices

MARKER = "▁"
PIECES_FILE = "piece_bpe_32k.model"
SLICE_BYTES = 4 << 20
TABLE_CHUNKS = 300_000
TABLE_BYTES = 16 << 20


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECES_FILE)


class Pieces:
    """A loaded model: chunks to ids, and ids to text."""

    def __init__(self, path: str):
        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [library.id_to_piece(i) for i in range(library.get_piece_size())]
        crossing = any(MARKER in p.lstrip(MARKER) for p in pieces)
        # A blank alone, kept at both ends, doubled, and other white space left as it is.
        probe = " a  b\n\tc "
        if crossing or library.decode(library.encode(probe)) != probe:
            raise ValueError(f"pieces of {path} cross blanks, or it changes white space")
        self.marker = library.piece_to_id(MARKER)
        special = [library.is_control(i) or library.is_unknown(i) or library.is_unused(i) for i in range(len(pieces))]
        self.bytes = [
            None if special[i] else bytes([int(p[3:-1], 16)]) if library.is_byte(i) else p.replace(MARKER, " ").encode()
            for i, p in enumerate(pieces)
        ]
        for i, p in enumerate(pieces):
            if library.is_control(i):
                self.bytes[i] = b""

    def segment(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks, each without its first marker, which the library puts back."""
        return [ids or [self.marker] for ids in self.library.encode(chunks, num_threads=1)]

    def text(self, ids: list[int]) -> str:
        """As the library's decode: the bytes of the pieces without the blank put in front. What
        isn't plain, such as bytes that are no text, is left to the library."""
        try:
            return b"".join([self.bytes[i] for i in ids]).decode().removeprefix(" ")
        except (TypeError, IndexError, UnicodeDecodeError):
            return self.library.decode(ids)


@lru_cache(1)
def pieces_of(path: str) -> Pieces:
    """One for each Python worker."""
    return Pieces(path)


def chunks_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct chunks of non-null texts, each without its first marker and with blanks for
    further ones; then, chunk by chunk, which of them it is; and where each text's begin."""
    lists = pc.split_pattern(pc.replace_substring(texts, MARKER, " "), " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    words = lists.flatten().dictionary_encode()
    distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
    which = words.indices.to_numpy().astype(np.int64)
    empty = distinct.index("") if "" in distinct else -1
    # An empty word is a marker more for the chunk that the next other word ends, or the text.
    closes = which != empty
    closes[offsets[1:] - 1] = True
    at = np.flatnonzero(closes)
    more = np.diff(at, prepend=-1) - 1
    which = which[at]
    bounds = np.searchsorted(at, offsets)
    several = np.flatnonzero(more)
    if len(several):
        pairs = np.stack([more[several], which[several]])
        kinds, kind = np.unique(pairs, axis=1, return_inverse=True)
        which[several] = len(distinct) + kind.ravel()
        distinct += [" " * n + distinct[w] for n, w in kinds.T.tolist()]
    # A text without characters has no chunk.
    none = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    if none.any():
        sizes = np.diff(bounds)
        which = which[np.repeat(~none, sizes)]
        bounds = np.concatenate([[0], np.cumsum(np.where(none, 0, sizes))])
    return distinct, which, bounds


class ChunkTable:
    """Distinct chunks and their ids: row ``n`` holds ``ids[ends[n - 1]:ends[n]]``."""

    def __init__(self, segment, chunks: int = TABLE_CHUNKS, size: int = TABLE_BYTES):
        self.segment, self.chunks, self.size = segment, chunks, size
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.ids, self.ends, self.held = np.zeros(0, np.int32), np.zeros(1, np.int64), 0

    def rows(self, chunks: list[str]) -> np.ndarray:
        """The rows of distinct chunks; those the table lacks are segmented and added."""
        if len(self.row) > self.chunks or self.held > self.size:
            self.clear()
        new = [c for c in chunks if c not in self.row]
        if new:
            found = self.segment(new)
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum()))
            self.row.update(zip(new, range(len(self.row), len(self.row) + len(new))))
            self.ids = np.concatenate([self.ids, flat])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])
            self.held += sum(map(len, new))
        return np.fromiter(map(self.row.__getitem__, chunks), np.int64, len(chunks))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of non-null texts, one after the other, and where each text's begin, with the end."""
        distinct, which, bounds = chunks_of(texts)
        rows = self.rows(distinct)[which]
        first, length = self.ends[rows], self.ends[rows + 1] - self.ends[rows]
        ends = np.concatenate([[0], np.cumsum(length)])
        place = np.repeat(first - ends[:-1], length) + np.arange(ends[-1])
        return self.ids[place], ends[bounds]


def encoded(
    docs: DataFrame, path: str | None = None, text: str = "text", key: str = "doc_id", end: bool = True
) -> DataFrame:
    """``key`` and ``ids``, an array, of every row: what the library encodes the whole text to, with
    the model's end id unless ``end`` is false.

    A null text is empty; an empty one has the end id alone. Repeated rows and keys are encoded one
    by one; a null key is a key. No rows give no rows; other columns are ignored. A model whose
    pieces cross blanks, or that changes white space, is an error.
    """
    path = path or default_path()
    last = [pieces_of(path).library.eos_id()] if end else []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(pieces_of(path).segment)
        for batch in batches:
            at = 0
            for texts in byte_slices(batch.column(1), SLICE_BYTES):
                flat, bounds = table.encode(texts)
                if last:
                    flat = np.insert(flat, bounds[1:], last[0])
                    bounds = bounds + np.arange(len(bounds))
                ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids], names=["key", "ids"])
                at += len(texts)

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decoded(rows: DataFrame, path: str | None = None, ids: str = "ids", to: str = "text") -> DataFrame:
    """``rows`` with the text that the library decodes ``ids`` to; of null ids the empty text."""
    path = path or default_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = pieces_of(path).text
        for batch in batches:
            texts = pa.array([text(i.as_py() or []) for i in batch.column(ids)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, to])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*rows.schema])
    return rows.mapInArrow(work, f"{fields}, `{to}` string")
