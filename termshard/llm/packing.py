"""Packing of token sequences by best fit over several capacities.

A bin has residual tokens, documents and attention cost (the sum of squared lengths). Pieces
are placed from long to short; of the bins that hold a piece under every constraint, the one
with the least weighted norm of what would be left is taken (``rule="norm"``), or the one with
the largest weighted dot product of piece and residual (``rule="dot"``); if none, a new one.

Spark deals the pieces out in groups of some thousands of rows, a number that doesn't grow
with the data, and packs each group as a task of its own. A group leaves about one sequence
less than full, so it costs a small fraction of a percent. The ids travel with their pieces, and
the task that packs a group puts its sequences together.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termshard.llm.common import scratch_path
from termshard.llm.encoding import default_path, encoder

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary, ids_crc32 bigint, copy int"
#: Bytes of text that make about a whole piece.
PIECE_BYTES = 8_192
#: What bounds a worker's memory: words whose ids it keeps, and bytes of text encoded at a time.
STORED_WORDS = 100_000
SLICE_BYTES = 2 << 20
SPAN = "struct<doc_id: bigint, piece: int, start: bigint, length: bigint, offset: bigint>"
SEQUENCES = f"sequence_id bigint, length bigint, ids binary, pieces array<{SPAN}>"
DIGEST = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


def cut_pieces(
    docs: DataFrame, size: int = 2048, end_id: int = 0, path: str | None = None,
    text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """Every document as ids with an end id, cut where it is longer than ``size``: doc_id, piece,
    start, length, ``ids`` (little-endian, of two bytes each where the tokenizer's ids fit, else
    four), ids_crc32, the checksum of the ids in four bytes each, and ``copy``, which numbers the
    pieces of a task that are equal in all of this.

    A null or empty text is the end id alone. Rows with repeated or null keys are documents
    of their own. No rows give no rows; other columns are ignored.
    """
    path = path or default_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, STORED_WORDS, STORED_WORDS // 4)
        encode, end = own.encode, np.array([end_id], "<u4")
        most = max(own.tokenizer.get_vocab(with_added_tokens=True).values())
        width = "<u2" if max(most, end_id) < 1 << 16 else "<u4"
        copies: Counter = Counter()
        for batch in batches:
            docs_left = iter(batch.column(0).to_pylist())
            for flat, bounds in encode(batch.column(1), SLICE_BYTES):
                rows = []
                for at, to in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    doc, ids = next(docs_left), np.concatenate([flat[at:to], end])
                    for piece, start in enumerate(range(0, len(ids), size)):
                        part = ids[start : start + size]
                        crc = zlib.crc32(part)
                        same = hash((doc, piece, len(part), crc))
                        rows.append((doc, piece, start, len(part), part.astype(width).tobytes(), crc, copies[same]))
                        copies[same] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, TYPES)],
                    names=["doc_id", "piece", "start", "length", "ids", "ids_crc32", "copy"],
                )

    return docs.select(F.col(key).cast("bigint"), F.col(text)).mapInArrow(work, PIECES)


TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32()]


def best_fit(
    lengths: np.ndarray, size: int, documents: int, attention: int,
    weights: tuple[float, float, float] = (1.0, 0.25, 0.25), rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece. Pieces longer than ``size`` don't occur; one whose squared
    length alone exceeds ``attention`` gets a bin of its own."""
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(-lengths, kind="stable")
    capacity = np.array([size, documents, attention], np.float64)
    scale = np.asarray(weights) / np.square(capacity)
    least = lengths[order[-1]] if n else 0
    left = np.zeros((1024, 3))  # residuals of the open bins, and their numbers
    names = np.zeros(1024, np.int64)
    opened = used = 0
    for i in order:
        t = lengths[i]
        item = np.array([t, 1, t * t], np.float64)
        after = left[:opened] - item
        fits = np.flatnonzero((after >= 0).all(axis=1))
        if len(fits):
            if rule == "norm":
                at = fits[np.argmin(np.square(after[fits]) @ scale)]
            else:
                at = fits[np.argmax(left[fits] @ (item * scale))]
        else:
            if opened == len(left):
                left, names = np.vstack([left, np.zeros_like(left)]), np.append(names, names * 0)
            at, opened = opened, opened + 1
            left[at], names[at] = capacity, used
            used += 1
        offsets[i], bins[i] = size - left[at, 0], names[at]
        left[at] -= item
        if left[at, 0] < least or left[at, 1] < 1 or left[at, 2] < least * least:  # full
            opened -= 1
            left[at], names[at] = left[opened], names[opened]
    return bins, offsets


def pack_pieces(
    pieces: DataFrame, size: int = 2048, documents: int | None = None,
    attention: int | None = None, rule: str = "norm", groups: int = 1,
) -> DataFrame:
    """The sequences of ``pieces``: sequence_id, ``length``, ``ids``, and ``pieces``, the spans
    (doc_id, piece, start, length, offset) in the order of their offsets, which leave no gap.

    Without ``documents`` or ``attention`` that capacity is the largest a sequence can use.
    Equal lengths are placed in the order of doc_id and piece. ``groups`` is the number of groups that
    the pieces are dealt into, by what they hold and, of equal ones, by their copy: neither a
    repeated task nor many copies of a piece change or crowd a group.
    """
    documents = documents or size
    attention = attention or size * size
    dealt = F.pmod(F.xxhash64("doc_id", "piece", "length", "ids_crc32", "copy"), F.lit(groups))
    grouped = pieces.select("doc_id", "piece", "start", "length", "ids", "copy", dealt.alias("_group"))

    def work(rows: pa.Table) -> pa.Table:
        order = [(c, "ascending") for c in ("doc_id", "piece", "copy")]
        rows = rows.take(pc.sort_indices(rows, sort_keys=order))
        bins, offsets = best_fit(rows["length"].to_numpy(), size, documents, attention, rule=rule)
        group = rows["_group"][0].as_py()
        placed = np.lexsort((offsets, bins))
        rows = rows.append_column("offset", pa.array(offsets)).take(placed).combine_chunks()
        bins = bins[placed]
        first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
        ends = np.r_[first, len(bins)]
        tokens = np.r_[0, np.cumsum(rows["length"].to_numpy())][ends]
        names = ("doc_id", "piece", "start", "length", "offset")
        spans = pa.StructArray.from_arrays([rows[n].combine_chunks() for n in names], names)
        data = b"".join(rows["ids"].to_pylist())
        at = (tokens * (len(data) // tokens[-1])).astype("<i4")
        ids = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(at), pa.py_buffer(data)])
        return pa.table({
            "sequence_id": (group << 32) + bins[first], "length": np.diff(tokens), "ids": ids,
            "pieces": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans),
        })

    return grouped.groupBy("_group").applyInArrow(work, SEQUENCES)


def groups_for(docs: DataFrame, text: str = "text", group_pieces: int = 8_192) -> int:
    """Groups of about ``group_pieces``: a document has a piece, and one more for every PIECE_BYTES."""
    size = F.sum(F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint"))
    row = docs.agg(F.count("*").alias("rows"), size.alias("size")).first()
    return max(1, round((row["rows"] + (row["size"] or 0) / PIECE_BYTES) / group_pieces))


def write_sequences(
    docs: DataFrame, to: str, size: int = 2048, end_id: int = 0, path: str | None = None
) -> None:
    """Cut and packed, as Parquet files of the rows of ``pack_pieces`` in the folder ``to``. The ids
    are made, shuffled once, and written. Null and empty texts are the end id alone, repeated rows are
    documents of their own, and no rows give no sequences."""
    pack_pieces(cut_pieces(docs, size, end_id, path), size, groups=groups_for(docs)).write.parquet(to)


def read_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of written sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset,
    the checksum being that of the ids that the sequence holds there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for sequence in batch.to_pylist():
                data, n = sequence["ids"], sequence["length"]
                ids = np.frombuffer(data, f"<u{len(data) // n}").astype("<u4")
                for p in sequence["pieces"]:
                    crc = zlib.crc32(ids[p["offset"] : p["offset"] + p["length"]])
                    rows.append((p["doc_id"], p["piece"], p["start"], p["length"], crc, sequence["sequence_id"], p["offset"]))
            names = [c.split()[0] for c in DIGEST.split(", ")]
            types = [pa.int32() if n == "piece" else pa.int64() for n in names]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, types)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return spark.read.schema(SEQUENCES).parquet(folder).mapInArrow(work, DIGEST)


def pack_documents(
    docs: DataFrame, size: int = 2048, end_id: int = 0, path: str | None = None, to: str | None = None
) -> DataFrame:
    """Writes the sequences to ``to``, else to a folder of the scratch space, and gives the
    pieces that are read back from there."""
    to = to or scratch_path(docs.sparkSession, "sequences")
    write_sequences(docs, to, size, end_id, path)
    return read_pieces(docs.sparkSession, to)
