"""Terms of documents from their token arrays, and new arrays from terms, many documents at a time.

A row per token, grouped again, costs far more than the tokens. Here the arrays go to Arrow batches.
Counts and positions are made of batches in which the rows of a document lie side by side, so a batch and its last
document are all that a task holds. Tokens are replaced shard by shard: Spark joins the distinct words of
a shard to their table, and the shard's arrays meet what comes of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["theme", "doc_id"]
ROWS_OUT = 50_000
GATHERED_ROWS = 1_000_000


def codes(column: pa.ChunkedArray) -> np.ndarray:
    """A number per value; null is a value."""
    return column.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()


def flattened(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """How many tokens each row has, none where there is no array, and the tokens of all."""
    lists = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    return lengths, lists.flatten()


def places(lengths: np.ndarray) -> np.ndarray:
    """0, 1, 2 and so on within each row."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def ranks(values: pa.Array) -> np.ndarray:
    """The place of each distinct value among them in order."""
    rank = np.empty(len(values), np.int64)
    rank[pc.sort_indices(values).to_numpy()] = np.arange(len(values))
    return rank


def document_numbers(rows: pa.Table) -> np.ndarray:
    """Numbers of the documents of sorted rows, from 0."""
    new = np.zeros(len(rows), bool)
    for key in KEYS:
        code = codes(rows[key])
        new[1:] |= code[1:] != code[:-1]
    return np.cumsum(new)


def whole_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows in tables that hold all rows of their documents."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        if not len(rows):
            continue
        number = document_numbers(rows)
        last = int(np.searchsorted(number, number[-1]))
        held = rows.slice(last)
        if last:
            yield rows.slice(0, last)
    if held is not None and len(held):
        yield held


def _positions(rows: pa.Table, schema: pa.Schema) -> pa.Table:
    lengths, flat = flattened(rows["tokens"])
    place = places(lengths)
    row = np.repeat(np.arange(len(rows)), lengths)
    known = flat.is_valid().to_numpy(zero_copy_only=False)
    if not known.all():
        flat, place, row = flat.drop_null(), place[known], row[known]
    if not len(flat):
        return schema.empty_table()
    words = flat.dictionary_encode()
    document, theme = document_numbers(rows), codes(rows["theme"])
    # By theme and term, as an index is sorted.
    key = theme[row].astype(np.int64) * len(words.dictionary) + ranks(words.dictionary)[words.indices.to_numpy()]
    key = key * (document[-1] + 1) + document[row]
    repeated = document[-1] + 1 < len(rows)
    order = np.lexsort((place, key)) if repeated else np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    at = row[order[first]]
    dl = np.maximum.reduceat(lengths[row[order]], first) if repeated else lengths[at]
    ends = np.r_[first, len(key)].astype(np.int32)
    columns = [
        rows["theme"].take(pa.array(at)),
        words.dictionary.take(words.indices.take(pa.array(order[first]))),
        rows["doc_id"].take(pa.array(at)),
        pa.array(np.diff(ends).astype(np.int64)),
        pa.ListArray.from_arrays(pa.array(ends), pa.array(place[order].astype(np.int32))),
        pa.array(dl),
    ]
    return pa.table(columns, names=schema.names).cast(schema)


def with_positions(sharded: DataFrame) -> DataFrame:
    """``(theme, term, doc_id, tf, positions, dl)`` of tokens whose rows of a document lie in one
    partition, and stay there."""
    kinds = {f.name: f.dataType.simpleString() for f in sharded.schema}
    result = (
        f"theme {kinds['theme']}, term string, doc_id {kinds['doc_id']}, tf bigint, positions array<int>, dl bigint"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for rows in whole_documents(batches):
            if schema is None:
                theme, doc_id = (rows.schema.field(k).type for k in KEYS)
                types = (theme, pa.string(), doc_id, pa.int64(), pa.list_(pa.int32()), pa.int64())
                schema = pa.schema(list(zip(("theme", "term", "doc_id", "tf", "positions", "dl"), types)))
            yield from _positions(rows, schema).to_batches(max_chunksize=ROWS_OUT)

    return sharded.select(*KEYS, "tokens").sortWithinPartitions(*KEYS).mapInArrow(work, result)


def _counts(rows: pa.Table, schema: pa.Schema, pause: str, min_len: int) -> pa.Table:
    document = document_numbers(rows)
    lists = pc.split_pattern(rows["text"].combine_chunks(), pause)
    parts = [(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(), lists.flatten()), flattened(rows["rest"])]
    words = pa.concat_arrays([flat for _, flat in parts]).dictionary_encode()
    document = np.concatenate([np.repeat(document, lengths) for lengths, _ in parts])
    long = pc.greater_equal(pc.utf8_length(words.dictionary), min_len).to_numpy(zero_copy_only=False)
    size, code = max(len(long), 1), pc.fill_null(words.indices, -1).to_numpy()
    kept = np.r_[long, False][code]
    key, tf = np.unique(document[kept] * size + code[kept], return_counts=True)
    document, code = np.divmod(key, size)
    # Sums of whole numbers are exact to 2 ** 53.
    dl, norm_sq = (np.bincount(document, tf.astype(np.float64) ** k).astype(np.int64) for k in (1, 2))
    at = pa.array(np.unique(document_numbers(rows), return_index=True)[1][document])
    columns = [
        rows["theme"].take(at), words.dictionary.take(pa.array(code)), rows["doc_id"].take(at),
        pa.array(tf), pa.array(dl[document]), pa.array(norm_sq[document]),
    ]
    return pa.table(columns, names=schema.names).cast(schema)


def with_counts(sharded: DataFrame, pause: str, min_len: int) -> DataFrame:
    """``(theme, term, doc_id, tf, dl, norm_sq)`` of the words in ``text``, with a pause between them, and in the
    array ``rest``. The rows of a document lie in one partition, and stay there."""
    kinds = {f.name: f.dataType.simpleString() for f in sharded.schema}
    names = ("theme", "term", "doc_id", "tf", "dl", "norm_sq")
    result = f"theme {kinds['theme']}, term string, doc_id {kinds['doc_id']}, tf bigint, dl bigint, norm_sq bigint"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for rows in whole_documents(batches):
            if schema is None:
                theme, doc_id = (rows.schema.field(k).type for k in KEYS)
                schema = pa.schema(list(zip(names, (theme, pa.string(), doc_id, *[pa.int64()] * 3))))
            yield from _counts(rows, schema, pause, min_len).to_batches(max_chunksize=ROWS_OUT)

    return sharded.select(*KEYS, "text", "rest").sortWithinPartitions(*KEYS).mapInArrow(work, result)


def _gathered(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    theme, doc_id = (codes(rows[k]) for k in KEYS)
    order = np.lexsort((doc_id, theme))
    theme, doc_id = theme[order], doc_id[order]
    first = np.flatnonzero(np.r_[True, (theme[1:] != theme[:-1]) | (doc_id[1:] != doc_id[:-1])])
    ends, at = pa.array(np.r_[first, len(order)].astype(np.int32)), pa.array(order[first])
    entries = rows["entry"].combine_chunks().take(pa.array(order))
    columns = [*(rows[k].combine_chunks().take(at) for k in KEYS), pa.ListArray.from_arrays(ends, entries)]
    yield from pa.table(columns, names=[*KEYS, "entries"]).to_batches(max_chunksize=ROWS_OUT)


def gathered(entries: DataFrame) -> DataFrame:
    """``(theme, doc_id, entries)``: rows ``(theme, doc_id, entry)`` of the same document as one, of GATHERED_ROWS
    rows that follow each other in a partition. A document may still have several."""
    kinds = {f.name: f.dataType.simpleString() for f in entries.schema}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= GATHERED_ROWS:
                yield from _gathered(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            yield from _gathered(pa.Table.from_batches(held))

    result = f"theme {kinds['theme']}, doc_id {kinds['doc_id']}, entries array<{kinds['entry']}>"
    return entries.select(*KEYS, "entry").mapInArrow(work, result)


def _replaced(rows: pa.Table, words: pa.Table, keep_unknown: bool, schema: pa.Schema) -> pa.Table:
    lengths, flat = flattened(rows["tokens"])
    words = words.filter(words["stem"].is_valid()).sort_by([("term", "ascending"), ("stem", "ascending")])
    terms, stems = words["term"].combine_chunks().dictionary_encode(), words["stem"].combine_chunks()
    count = np.bincount(terms.indices.to_numpy(), minlength=len(terms.dictionary))
    start = np.cumsum(count) - count
    word = pc.fill_null(pc.index_in(flat, value_set=terms.dictionary), -1).to_numpy()
    known = word >= 0
    # A token becomes the stems of its word, itself or nothing.
    made, first = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
    made[known], first[known] = count[word[known]], start[word[known]]
    if keep_unknown:
        alone = ~known & flat.is_valid().to_numpy(zero_copy_only=False)
        made[alone], first[alone] = 1, len(stems) + np.flatnonzero(alone)
    value = np.repeat(first, made) + places(made)
    row = np.repeat(np.repeat(np.arange(len(rows)), lengths), made)
    tokens = (pa.concat_arrays([stems, flat]) if keep_unknown else stems).take(pa.array(value))
    theme, doc_id = (codes(rows[k]).astype(np.int64) for k in KEYS)
    _, at, document = np.unique(theme * (doc_id.max() + 1) + doc_id, return_index=True, return_inverse=True)
    if len(at) < len(rows):  # rows of the same document are one, in the order of places
        encoded = tokens.dictionary_encode()
        rank = ranks(encoded.dictionary)[encoded.indices.to_numpy()]
        order = np.lexsort((rank, np.repeat(places(lengths), made), document[row]))
        tokens, row, rows = tokens.take(pa.array(order)), document[row], rows.take(pa.array(at))
    ends = np.r_[0, np.cumsum(np.bincount(row, minlength=len(rows)))].astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), tokens)
    return pa.table([rows["theme"], rows["doc_id"], lists], names=schema.names).cast(schema)


def replaced(tokens: DataFrame, table: DataFrame, shards: int, fits: bool, keep_unknown: bool) -> DataFrame:
    """``(theme, doc_id, tokens)`` with each token replaced by its stem in ``table`` (term, stem, uses),
    or left out. ``fits``: whether the table may be broadcast."""
    shard = F.pmod(F.hash("doc_id"), F.lit(shards)).alias("shard")
    rows = tokens.select(shard, *KEYS, "tokens").repartition(shards, "shard")
    kinds = {f.name: f.dataType.simpleString() for f in tokens.schema}

    def distinct(rows: pa.Table) -> pa.Table:
        terms = flattened(rows["tokens"])[1].unique().drop_null()
        return pa.table({"shard": pa.array(np.full(len(terms), rows["shard"][0].as_py(), np.int32)), "term": terms})

    def work(rows: pa.Table, words: pa.Table) -> pa.Table:
        theme, doc_id = (rows.schema.field(k).type for k in KEYS)
        schema = pa.schema(list(zip([*KEYS, "tokens"], (theme, doc_id, pa.list_(pa.string())))))
        return _replaced(rows, words, keep_unknown, schema)

    words = rows.groupBy("shard").applyInArrow(distinct, "shard int, term string")
    # However frequent a word is, it is one row a shard: no key is hot.
    stems = table.filter("stem IS NOT NULL").select("term", "stem")
    words = words.join(F.broadcast(stems) if fits else stems, "term")
    words = words.select("shard", "term", "stem").repartition(shards, "shard")
    result = f"theme {kinds['theme']}, doc_id {kinds['doc_id']}, tokens array<string>"
    return rows.groupBy("shard").cogroup(words.groupBy("shard")).applyInArrow(work, result)
