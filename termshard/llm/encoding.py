"""Token ids of whole texts by a tokenizer of the tokenizers library, once per distinct word.

The tokenizer's pre-tokenizer never joins characters across white space, so the ids of a text
are those of its blank-separated words in order. Words repeat, within a batch (Arrow's dictionary
encoding finds the distinct ones) and between batches (a store), and of a new word only the
parts that are new are handed to the library. Both stores are bounded: when one is full its
words become the older generation, and what is not used again goes.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

WORDS_FILE = "word_bpe_49k.json"
#: Fixed value: the parts into which this tokenizer file splits a text.
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Below this, no character is a combining mark: normalising changes nothing.
LATIN_END = "ɐ"
CHUNK_BYTES = 8 << 20


def byte_letters() -> dict[int, int]:
    """The letter by which byte-level vocabularies write a byte: printable bytes themselves,
    the others, in order, from 256 on."""
    own = [b for b in range(256) if chr(b).isprintable() and b != 32]
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


class Store(dict):
    """A dictionary that makes missing values, and forgets those not used lately."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()


def byte_slices(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """The texts (or bytes), null as empty, in slices of about ``size`` bytes or one longer text."""
    kind = pa.large_binary() if pa.types.is_binary(texts.type) else pa.large_string()
    texts = pc.fill_null(texts.cast(kind), pa.scalar("", kind) if kind == pa.large_string() else pa.scalar(b"", kind))
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield texts.slice(at, to - at)
        at = to


class Encoder:
    def __init__(self, path: str, words: int = 500_000, parts: int = 100_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.words, self.parts = Store(self._word, words), Store(self._part, parts)

    def _part(self, part: str) -> bytes:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(part)]).tobytes()

    def _word(self, word: str) -> bytes:
        if (word.isascii() or max(word) < LATIN_END) and word.isprintable() and "<|" not in word:
            low = word.lower()
            if low.isalpha():
                return self._part(low)
            return b"".join(map(self.parts.__getitem__, PARTS.findall(low)))
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.replace_substring(texts, "\n", " ")
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # special tokens have case
            texts = pc.ascii_lower(texts)
        # A point or comma that ends a word is a part of its own.
        texts = pc.replace_substring_regex(texts, r"([a-z])([.,])( |$)", r"\1 \2\3")
        lists = pc.split_pattern(texts, " ")
        words = lists.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(map(self.words.__getitem__, distinct), pa.large_binary())
        self.words.trim()
        self.parts.trim()
        ids = ids.take(words.indices)
        _, ends, data = ids.buffers()
        ends = np.frombuffer(ends, np.int64, len(ids) + 1) >> 2
        flat = np.frombuffer(data if data else b"", "<u4", ends[-1])
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return flat, ends[bounds]

    def encode(self, texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of whole texts, a null one having none, and where each text's begin, with the
        end: for slices of the texts of about ``size`` bytes, in order."""
        for part in byte_slices(texts, size):
            yield self._encode(part)


@lru_cache(1)
def encoder(path: str, words: int = 500_000, parts: int = 100_000) -> Encoder:
    """One for each Python worker."""
    return Encoder(path, words, parts)


def default_path() -> str:
    return public_tokenizers.path(WORDS_FILE)
