"""Token ids of a corpus in files of range-coded blocks, and back.

Rows are range-partitioned and sorted by key, so that ids lie in ascending key order. A task
encodes its documents into blocks of about BLOCK_IDS ids, whole documents each. Blocks are rows
of a Parquet table (file, block, n_ids, payload), written and committed by Spark: a lost
executor costs its tasks and nothing else. A payload is the key and length of each document,
compressed, and the block of ``range_coder``. Any block can be read alone.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termshard.llm.encoding import default_path, encoder
from termshard.llm.range_coder import decode_block, encode_block

BLOCK_IDS = 1 << 21
BLOCKS = "file int, block int, n_ids bigint, payload binary"
BACK = "file int, block int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint"
INDEX = struct.Struct("<QI")


def _payload(keys: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """Keys and lengths, compressed, then the coded ids. A missing key is marked in a bit set."""
    missing = np.packbits(np.array([k is None for k in keys]), bitorder="little").tobytes()
    known = np.array([k or 0 for k in keys], "<i8").tobytes()
    index = zlib.compress(missing + known + np.array(lengths, "<u8").tobytes(), 1)
    return INDEX.pack(len(keys), len(index)) + index + encode_block(ids)


def read_payload(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Keys, lengths and ids of a block."""
    n, size = INDEX.unpack_from(payload)
    index = zlib.decompress(payload[INDEX.size : INDEX.size + size])
    bits = -(-n // 8)
    missing = np.unpackbits(np.frombuffer(index, np.uint8, bits), count=n, bitorder="little")
    keys = np.frombuffer(index, "<i8", n, bits).tolist()
    lengths = np.frombuffer(index, "<u8", n, bits + 8 * n).astype(np.int64)
    keys = [None if gone else k for k, gone in zip(keys, missing)]
    return keys, lengths, decode_block(payload[INDEX.size + size :])


def write_tokens(
    docs: DataFrame, folder: str, end_id: int = 1, path: str | None = None,
    text: str = "text", key: str = "doc_id",
) -> None:
    """Every document's ids and an end id, in ascending order of the key, nulls first; rows with
    the same key in the order in which they are read. A null or empty text is the end id
    alone. No rows make an empty table. Other columns are ignored."""
    path = path or default_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block = TaskContext.get().partitionId(), 0
        encode, end = encoder(path).encode, np.array([end_id], "<u4")
        keys, lengths, pieces, held = [], [], [], 0

        def finished() -> pa.RecordBatch:
            row = ([file], [block], [held], [_payload(keys, lengths, np.concatenate(pieces))])
            types = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(row, types)], names=["file", "block", "n_ids", "payload"]
            )

        for batch in batches:
            left = iter(batch.column(0).to_pylist())
            for flat, bounds in encode(batch.column(1)):
                for at, to in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    keys.append(next(left))
                    lengths.append(to - at + 1)
                    pieces += [flat[at:to], end]
                    held += to - at + 1
                    if held >= BLOCK_IDS:
                        yield finished()
                        block += 1
                        keys, lengths, pieces, held = [], [], [], 0
        if keys:
            yield finished()

    rows = docs.select(
        F.col(key).cast("bigint").alias("_id"), F.col(text).alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    ordered = rows.repartitionByRange("_id", "_row").sortWithinPartitions("_id", "_row")
    blocks = ordered.select("_id", "_text").mapInArrow(work, BLOCKS)
    blocks.write.option("compression", "none").parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of each document,
    from the files. A damaged block fails."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, block, payload in zip(*(c.to_pylist() for c in batch.columns)):
                keys, lengths, ids = read_payload(payload)
                ends = np.cumsum(lengths)
                data = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, file, np.int32)), pa.array(np.full(n, block, np.int32)),
                        pa.array(keys, pa.int64()), pa.array(ends - lengths), pa.array(lengths),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["file", "block", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    blocks = spark.read.schema(BLOCKS).parquet(folder)
    # Starts: a running sum within each file, and one over the totals of files, a row each.
    inside = Window.partitionBy("file").orderBy("block")
    light = blocks.select("file", "block", "n_ids")
    starts = light.withColumn("_in", F.sum("n_ids").over(inside) - F.col("n_ids"))
    files = light.groupBy("file").agg(F.sum("n_ids").alias("_all"))
    files = files.select("file", (F.sum("_all").over(Window.orderBy("file")) - F.col("_all")).alias("_before"))
    starts = starts.join(files, "file").select("file", "block", (F.col("_in") + F.col("_before")).alias("_start"))
    docs = blocks.select("file", "block", "payload").mapInArrow(work, BACK)
    return docs.join(starts, ["file", "block"]).select(
        "doc_id", (F.col("_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
