"""How document filters interact: what each removes, alone, first or after others.

Texts are measured by a finite-state transducer over their UTF-8 bytes. Its table has a row per
state (between words, in a word) and a column per byte; an entry says what the byte counts as: a
code point, a capital, a symbol, a word's begin or end. The state after a byte depends on that
byte alone, so the pass is a table look-up over whole slices of bytes. The spans of words go into
a hash table with open addressing as they end; a span that meets an equal hash is compared byte
by byte, so different words never count as one.

What a filter removes in a given order follows from which filters a document fails. Documents
are counted by these failures, and the counts alone, a few rows a part, are put through all
orders of the filters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termshard.llm.encoding import byte_slices

# Blanks, symbols, and the filters' letters.
BLANK_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOL_BYTES = b"#$%&*|"
FILTERS = "ABCDE"

START, END, CAPITAL, CODE_POINT, SYMBOL = 1, 2, 4, 8, 16
SLICE_BYTES = 2 << 20
BLOCK_BYTES = 4 << 20
LONG_WORD = 64
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
#: Keeps the first 0 to 8 bytes of a little-endian number.
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def transducer() -> tuple[np.ndarray, np.ndarray]:
    """What a byte emits by state (0 between words, 1 in one) and byte, and the state after it."""
    after = np.ones(256, np.uint16)
    after[list(BLANK_BYTES)] = 0
    emits = np.zeros((2, 256), np.uint8)
    emits[0, after == 1] |= START
    emits[1, after == 0] |= END
    emits[:, ord("A") : ord("Z") + 1] |= CAPITAL
    emits[:, :0x80] |= CODE_POINT
    emits[:, 0xC0:] |= CODE_POINT  # 80 to BF continue a code point
    emits[:, list(SYMBOL_BYTES)] |= SYMBOL
    return emits.ravel(), after


EMITS, AFTER = transducer()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX[0]
    return (h ^ (h >> np.uint64(29))) * MIX[1]


class SpanTable:
    """Spans of bytes, each with an owner, that are told apart by their bytes.

    ``data`` must end with 8 bytes beyond the last span."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        self.slots = np.full(1024, -1, np.int64)
        self.held = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]  # owner, start, length, hash

    def _eight(self, start: np.ndarray, length: np.ndarray, at: int) -> np.ndarray:
        return self.eights[start + at] & FIRST_BYTES[np.minimum(length - at, 8)]

    def _hashes(self, owner: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        h = mixed((owner.astype(np.uint64) << np.uint64(24)) ^ length.astype(np.uint64) ^ MIX[2])
        todo = np.arange(len(start))
        for at in range(0, LONG_WORD, 8):
            h[todo] = mixed(h[todo] ^ self._eight(start[todo], length[todo], at))
            todo = todo[length[todo] > at + 8]
        for i in todo.tolist():
            rest = self.data[start[i] + LONG_WORD : start[i] + length[i]]
            h[i] ^= np.uint64(xxhash.xxh3_64_intdigest(rest))
        return h

    def _equal(self, one: np.ndarray, two: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether spans of the same length hold the same bytes."""
        same = np.ones(len(one), bool)
        todo = np.arange(len(one))
        for at in range(0, LONG_WORD, 8):
            a, b = (self._eight(s[todo], length[todo], at) for s in (one, two))
            same[todo] = a == b
            todo = todo[(length[todo] > at + 8) & same[todo]]
        for i in todo.tolist():
            a, b = (self.data[s[i] : s[i] + length[i]] for s in (one, two))
            same[i] = np.array_equal(a, b)
        return same

    def _reserve(self, more: int) -> None:
        held = len(self.held[0])
        if 2 * (held + more) <= len(self.slots):
            return
        self.slots = np.full(1 << (2 * (held + more)).bit_length(), -1, np.int64)
        todo, at = np.arange(held), self.held[3].astype(np.int64) & (len(self.slots) - 1)
        while len(todo):  # what is held is distinct already
            free = todo[self.slots[at[todo]] < 0]
            self.slots[at[free]] = free
            todo = todo[self.slots[at[todo]] != todo]
            at[todo] = (at[todo] + 1) & (len(self.slots) - 1)

    def insert(self, owner: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Which of the spans their owner did not have yet."""
        self._reserve(len(start))
        first = len(self.held[0])
        new = [owner, start, length, self._hashes(owner, start, length)]
        every = [np.concatenate(pair) for pair in zip(self.held, new)]
        owners, starts, lengths, hashes = every
        last = len(self.slots) - 1
        todo = np.arange(first, len(owners))
        at = hashes.astype(np.int64) & last  # of every span, the slot to look at
        fresh = np.zeros(len(owners), bool)
        while len(todo):
            free = todo[self.slots[at[todo]] < 0]
            self.slots[at[free]] = free
            there = self.slots[at[todo]]
            fresh[todo[there == todo]] = True
            left = there != todo
            todo, there = todo[left], there[left]
            alike = (hashes[there] == hashes[todo]) & (owners[there] == owners[todo]) & (lengths[there] == lengths[todo])
            pairs = np.flatnonzero(alike)
            alike[pairs] = self._equal(starts[there[pairs]], starts[todo[pairs]], lengths[todo[pairs]])
            todo = todo[~alike]
            at[todo] = (at[todo] + 1) & last
        # Only what is new stays, numbered anew.
        kept = np.flatnonzero(fresh)
        self.slots[at[kept]] = np.arange(first, first + len(kept))
        self.held = [np.concatenate([h, n[kept - first]]) for h, n in zip(self.held, new)]
        return fresh[first:]


def scanned(texts: pa.Array) -> np.ndarray:
    """Of each text, in one pass over its bytes: words, distinct words, capitals, code points and
    symbols, as the rows of an array. Null counts as empty. Blocks carry the state and an open
    word over, so memory beyond the bytes themselves follows the block and the distinct words."""
    n = len(texts)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes + 1)  # every text ends with a blank of its own
    nothing = pa.scalar("", pa.large_string())
    closed = pc.binary_join_element_wise(texts, nothing, pa.scalar(" ", pa.large_string()))
    data = np.full(ends[-1] + 8, 0x20, np.uint8)
    data[: ends[-1]] = np.frombuffer(closed.buffers()[2], np.uint8, ends[-1])
    table, counts = SpanTable(data), np.zeros((5, n), np.int64)
    state, open_at = np.uint16(0), -1
    for low in range(0, int(ends[-1]), BLOCK_BYTES):
        high = min(low + BLOCK_BYTES, int(ends[-1]))
        block = data[low:high]
        after = AFTER[block]
        emitted = EMITS[(np.concatenate([[state], after[:-1]]).astype(np.uint16) << 8) | block]
        state = after[-1]
        texts_here = slice(int(np.searchsorted(ends, low, "right")), int(np.searchsorted(ends, high - 1, "right")) + 1)
        begins = np.maximum(np.concatenate([[0], ends[:-1]])[texts_here] - low, 0)
        for row, what in ((2, CAPITAL), (3, CODE_POINT), (4, SYMBOL)):
            counts[row, texts_here] += np.add.reduceat((emitted & what) != 0, begins, dtype=np.int64)
        starts, stops = (np.flatnonzero(emitted & what) + low for what in (START, END))
        if open_at >= 0:
            starts = np.concatenate([[open_at], starts])
        open_at = int(starts[-1]) if len(starts) > len(stops) else -1
        starts = starts[: len(stops)]
        owner = np.searchsorted(ends, starts, "right")
        new = table.insert(owner, starts, stops - starts)
        counts[0] += np.bincount(owner, minlength=n)
        counts[1] += np.bincount(owner[new], minlength=n)
    counts[3] -= 1  # the blank after each text
    return counts


MEASURES = ("n_words", "n_distinct", "n_capitals", "n_chars", "n_symbols")


def measured(docs: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang") -> DataFrame:
    """Per row: the key, ``part`` (null as empty), the measures, and the text's SHA-256."""
    schema = "doc_id bigint, part string, " + ", ".join(f"{m} bigint" for m in MEASURES) + ", digest binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in byte_slices(batch.column(2), SLICE_BYTES):
                rows = batch.slice(at, len(texts))
                at += len(texts)
                digests = [hashlib.sha256(t.as_buffer()).digest() for t in texts]
                columns = [*rows.columns[:2], *map(pa.array, scanned(texts)), pa.array(digests, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", *MEASURES, "digest"])

    source = docs.select(
        F.col(key).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(text).cast("string").alias("text"),
    )
    return source.mapInArrow(work, schema)


def _letters(conditions: dict[str, str]):
    """The letters, in order, of the SQL conditions that hold."""
    return F.concat(*(F.expr(f"IF({c}, '{letter}', '')") for letter, c in conditions.items()))


def failure_counts(measures: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part and the filters they fail: part, ``fails`` (letters), n, good, toxic.

    A: under 200 words. B: fewer than half of the words distinct. C: more than 3 % capitals.
    D: a symbol. E: the text of a smaller key. Of equal texts the rows of the smallest key
    pass; a row without a key is not compared and has no label. A key is good or toxic if any of
    its labels says so. Copies meet as counts by text, key and part, so no group of them is
    large, and only keys and digests are shuffled.
    """
    own = _letters(
        {"A": "n_words < 200", "B": "100 * n_distinct < 50 * n_words", "C": "100 * n_capitals > 3 * n_chars", "D": "n_symbols > 0"}
    )
    rows = measures.select("doc_id", "part", "digest", own.alias("own"))
    rows = rows.groupBy("doc_id", "digest", "part", "own").agg(F.count("*").alias("n"))
    said = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    rows = rows.join(said, "doc_id", "left").withColumns(
        {c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")}
    )
    copies = rows.groupBy("digest", "part", "own", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("least"),
        F.coalesce(F.min_by("n", "doc_id"), F.lit(0)).alias("of_least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("keyless"),
    )
    smallest = F.min("least").over(Window.partitionBy("digest"))
    first = F.col("keyless") + F.when(F.col("least") == smallest, F.col("of_least")).otherwise(0)
    copies = copies.withColumn("first", first)
    both = F.array(
        F.struct(F.col("own").alias("fails"), F.col("first").alias("n")),
        F.struct(F.concat("own", F.lit("E")).alias("fails"), (F.col("n") - F.col("first")).alias("n")),
    )
    cells = copies.select("part", "good", "toxic", F.inline(both)).filter("n > 0")
    return cells.groupBy("part", "fails").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def interactions(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """``cells`` (part, fails, n, good, toxic) through every order of ``filters``: one row per part,
    ``filter_order`` and ``step`` with the documents kept after the step, removed there, redundant
    (removed before, failing here as well), failing this filter alone, the good and toxic ones
    among the removed, and ``shapley``, the filter's removed over all orders."""
    orders = " ".join(map("".join, permutations(filters)))
    rows = cells.withColumn("filter_order", F.explode(F.split(F.lit(orders), " ")))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))
    rows = rows.withColumns(
        {
            "filter": F.expr("substring(filter_order, step, 1)"),
            "gone": F.expr("translate(left(filter_order, step - 1), fails, '') <> left(filter_order, step - 1)"),
        }
    ).withColumn("failed", F.expr("locate(filter, fails) > 0"))

    def total(condition: str, of: str = "n"):
        return F.sum(F.expr(f"IF({condition}, {of}, 0L)"))

    steps = rows.groupBy("part", "filter_order", "step", "filter").agg(
        total("NOT gone AND NOT failed").alias("kept"),
        total("NOT gone AND failed").alias("removed"),
        total("gone AND failed").alias("redundant"),
        total("fails = filter").alias("unique_fails"),
        total("NOT gone AND failed", "good").alias("good_lost"),
        total("NOT gone AND failed", "toxic").alias("toxic_lost"),
    )
    over_orders = Window.partitionBy("part", "filter")
    return steps.withColumn("shapley", F.sum("removed").over(over_orders)).drop("filter")


def filter_audit(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang"
) -> DataFrame:
    """The interactions of the five filters on ``docs``, one row per part, order and step.

    A null text is empty; a null part is the empty string; repeated rows count as often as they
    occur, and copies under one key are that key's; labels of no document and null labels say
    nothing. No rows give no rows; other columns are ignored.
    """
    return interactions(failure_counts(measured(docs, text, key, part), labels))
