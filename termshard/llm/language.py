"""Language identification, words first.

A text is scored by its words, runs of letters. A word that the model knows adds its log frequency
in each language; an unknown one is judged by the mean of those of its character 4-grams that are
known, or if none is, of its 3-grams, and so on down to single letters. The language with the
largest sum wins; the score is its share among all, by softmax over the mean per word of at most
SHARP words.

The model is fitted on a bounded sample of labelled documents: of every language up to
``sample_docs`` distinct ones, those with the smallest hashes. Each language has the same share of
the words and n-grams kept, its most frequent ones, so a rare language keeps its own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termshard.llm.common import materialized
from termshard.llm.encoding import byte_slices
from termshard.operators.ranking import top_n

LONGEST = 4
SHARP = 24
SLICE_BYTES = 2 << 20
#: Numbers in a model's table of words or n-grams, and in a worker's table of scored tokens.
CELLS = 4 << 20
RUNS = re.compile(r"[^\W\d_]+")
LETTERS = regex.compile(r"\p{L}+")
UNKNOWN = "und"


@dataclass
class Model:
    """For words and for n-grams (``^`` and ``$`` at a word's ends) the row of each in a table of log
    frequencies by language."""

    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased. What the quick pattern finds may hold digits like ² or Ⅷ."""
    found = RUNS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in ([run] if run.isalpha() else LETTERS.findall(run))]


def grams_of(word: str, n: int) -> list[str]:
    padded = f"^{word}$" if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def _counts(counts: Counter, names: list[str]) -> pa.RecordBatch:
    """Counts by tuples of texts."""
    columns = zip(*counts) if counts else [()] * (len(names) - 1)
    arrays = [pa.array(c, pa.string()) for c in columns]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(counts.values(), pa.int64())], names=names)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts.update((lang, w) for w in words_of(text.as_py() or ""))
        yield _counts(counts, ["lang", "entry", "n"])


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            for size in range(1, LONGEST + 1):
                for gram in grams_of(word, size):
                    counts[lang, gram] += n
        yield _counts(counts, ["lang", "entry", "n"])


def _table(counts: DataFrame, most: int, languages: list[str], by_size: bool) -> tuple[dict[str, int], np.ndarray]:
    """The smoothed log frequencies of the entries that are among the most frequent of a language,
    among entries of one length for n-grams. At most CELLS counts come to the driver."""
    each = max(1, min(most, CELLS // max(1, len(languages))) // max(1, len(languages)))
    chosen = top_n(counts, each, ["lang"], [F.desc("n"), F.col("entry")]).select("entry").distinct()
    rows = counts.join(chosen, "entry").select("entry", "lang", "n").collect()
    at = {lang: i for i, lang in enumerate(languages)}
    row: dict[str, int] = {}
    for r in rows:
        row.setdefault(r["entry"], len(row))
    found = np.zeros((len(row), len(languages)))
    for r in rows:
        found[row[r["entry"]], at[r["lang"]]] = r["n"]
    size = np.fromiter((len(e) if by_size else 0 for e in row), np.int64, len(row))
    for s in np.unique(size):
        own = found[size == s]
        found[size == s] = np.log((own + 0.5) / (own.sum(axis=0) + 0.5 * len(own)))
    return row, found


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
    sample_docs: int = 4_000, words: int = 200_000, grams: int = 200_000, languages: int = 500,
) -> Model:
    """A model of the labelled ``docs``: of each of the ``languages`` most frequent languages at most
    ``sample_docs`` distinct documents, and ``words`` and ``grams`` in equal parts. Rows without
    a language don't count; no rows give a model that knows nothing."""
    labelled = docs.filter(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(key), F.col(text)).alias("h"),
    )
    largest = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    known = sorted(r["lang"] for r in largest)
    labelled = labelled.filter(F.col("lang").isin(known)) if known else labelled.filter(F.lit(False))
    if any(r["n"] > sample_docs for r in largest):
        nearest = top_n(labelled.select("lang", "h").distinct(), sample_docs, ["lang"], [F.col("h")])
        bounds = nearest.groupBy("lang").agg(F.max("h").alias("bound"))
        labelled = labelled.join(F.broadcast(bounds), "lang").filter("h <= bound")  # a row a language
    sample = labelled.groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text")
    schema = "lang string, entry string, n bigint"
    counted = sample.mapInArrow(_word_counts, schema).groupBy("lang", "entry").agg(F.sum("n").alias("n"))
    counted = materialized(counted)
    parts = materialized(counted.mapInArrow(_gram_counts, schema).groupBy("lang", "entry").agg(F.sum("n").alias("n")))
    return Model(known, *_table(counted, words, known, False), *_table(parts, grams, known, True))


def _summed(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive ``rows``, ``sizes`` of them each; zeros for none."""
    out = np.zeros((len(sizes), rows.shape[1]))
    some = sizes > 0
    if some.any():
        out[some] = np.add.reduceat(rows, (np.cumsum(sizes) - sizes)[some], axis=0)
    return out


class Scorer:
    """Scores tokens, each distinct one once while its table lasts: the summed scores of its words
    by language, and the number of words."""

    def __init__(self, model: Model, cells: int = CELLS):
        self.model, self.width = model, len(model.languages) + 1
        self.most = max(1, cells // self.width)
        self.row, self.table = {}, np.zeros((0, self.width))

    def word_scores(self, words: list[str]) -> np.ndarray:
        """By language; zeros for a word none of whose letters is known."""
        model = self.model
        rows = np.fromiter((model.words.get(w, -1) for w in words), np.int64, len(words))
        out = np.zeros((len(words), len(model.languages)))
        out[rows >= 0] = model.word_scores[rows[rows >= 0]]
        todo = np.flatnonzero(rows < 0).tolist()
        for n in range(LONGEST, 0, -1):
            found = [[r for g in grams_of(words[i], n) if (r := model.grams.get(g)) is not None] for i in todo]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((r for part in found for r in part), np.int64, int(sizes.sum()))
            sums = _summed(model.gram_scores[flat], sizes)
            some = np.flatnonzero(sizes)
            at = np.array(todo, np.int64)
            out[at[some]] = sums[some] / sizes[some, None]
            todo = at[sizes == 0].tolist()
        return out

    def rows(self, tokens: list[str]) -> np.ndarray:
        """The rows of distinct tokens in the table; those it lacks are scored and added."""
        if len(self.row) > self.most:
            self.row, self.table = {}, self.table[:0]
        new = [t for t in tokens if t not in self.row]
        if new:
            lists = [words_of(t) for t in new]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            number: dict[str, int] = {}
            which = np.fromiter((number.setdefault(w, len(number)) for x in lists for w in x), np.int64, int(sizes.sum()))
            sums = _summed(self.word_scores(list(number))[which], sizes)
            self.row.update(zip(new, range(len(self.row), len(self.row) + len(new))))
            self.table = np.vstack([self.table, np.column_stack([sums, sizes])])
        return np.fromiter(map(self.row.__getitem__, tokens), np.int64, len(tokens))

    def texts(self, texts: pa.Array) -> np.ndarray:
        """The summed scores and the number of words of each text."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        tokens = lists.flatten().dictionary_encode()
        rows = self.rows(tokens.dictionary.to_numpy(zero_copy_only=False).tolist())
        which = rows[tokens.indices.to_numpy()]
        sizes = np.diff(lists.offsets.to_numpy())
        owner = np.repeat(np.arange(len(sizes)), sizes)
        out = np.zeros((len(sizes), self.width))
        for low in range(0, len(which), self.most):  # a bound on what is gathered at a time
            part = slice(low, low + self.most)
            own, counts = np.unique(owner[part], return_counts=True)
            out[own] += _summed(self.table[which[part]], counts)
        return out


def verdicts(model: Model, sums: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Languages and shares of summed scores; the first language of equals."""
    n = sums[:, -1:]
    if not model.languages:
        return [UNKNOWN] * len(sums), np.zeros(len(sums))
    mean = sums[:, :-1] / np.maximum(n, 1) * np.minimum(n, SHARP)
    best = mean.argmax(axis=1)
    top = mean[np.arange(len(mean)), best]
    share = 1 / np.exp(mean - top[:, None]).sum(axis=1)
    some = n[:, 0] > 0
    return [model.languages[b] if s else UNKNOWN for b, s in zip(best, some)], np.where(some, share, 0.0)


def predict(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key, ``lang_pred`` and ``score`` of every row.

    Texts are read whole. Null texts and those without a letter are ``und`` with score 0, as are
    all if the model knows no language. Repeated rows and keys are judged one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [key, "lang_pred", "score"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scorer = Scorer(model)
        for batch in batches:
            at = 0
            for texts in byte_slices(batch.column(1), SLICE_BYTES):
                langs, shares = verdicts(model, scorer.texts(texts))
                columns = [batch.column(0).slice(at, len(texts)), pa.array(langs, pa.string()), pa.array(shares)]
                at += len(texts)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(work, f"`{key}` {kind}, lang_pred string, score double")


def held_out(key: str | Column = "doc_id") -> Column:
    """A fifth of the documents: crc32 of the id as text, modulo 5, is 0. Not where it is null."""
    column = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))
