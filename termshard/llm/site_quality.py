"""Document quality from the text and from the site.

A logistic classifier on a few shares of the text and on the words most telling of bad
documents is fitted on a bounded sample of labelled documents; its log-odds less those of the
base rate are the document's evidence. Labelled outcomes of all documents, counted by path and
host, give the prior: a path is shrunk towards its host and a host towards all documents, each
level with a prior strength found by moments, so that sparse sites fall back to the global
rate. Evidence and the log-odds of the prior add up. A document's own label never counts
towards its own prior.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termshard.llm.common import materialized
from termshard.llm.encoding import CHUNK_BYTES, Store, byte_slices
from termshard.llm.host_reputation import prior_strength
from termshard.operators.bounds import broadcast_if_small

SYMBOLS = re.compile(r"[#*$%&|<>]")
EDGES = ".,;:!?*#$%&|<>\"'()"
FEATURES = ("symbols", "capitals", "shouts", "stutters", "dup_lines", "length", "worst_word", "telling_words")
MOST_EVIDENCE = 8.0


@dataclass
class Classifier:
    """Log ratios of telling words, and the weights of the standardised features."""

    words: dict[str, float] = field(default_factory=dict)
    centre: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    scale: np.ndarray = field(default_factory=lambda: np.ones(len(FEATURES)))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES) + 1))
    base: float = 0.0


def bare(token: str) -> str:
    return token.strip(EDGES).lower()


def token_marks(words: dict[str, float], token: str) -> np.ndarray:
    """Of a token: 1 if it is one; symbols, capitals and shouting in it; its word's log ratio."""
    ratio = words.get(bare(token), 0.0)
    loud = len(token) > 2 and token.isupper()
    return np.array([token != "", bool(SYMBOLS.search(token)), loud, "!!" in token, ratio, ratio > 0], np.float64)


def features(texts: pa.Array, store: Store) -> np.ndarray:
    """A row of FEATURES for each text; null and empty texts have zeros."""
    rows = []
    for part in byte_slices(texts, CHUNK_BYTES // 4):
        lists = pc.split_pattern(pc.replace_substring(part, "\n", " "), " ")
        tokens = lists.flatten().dictionary_encode()
        marks = np.array([store[t] for t in tokens.dictionary.to_numpy(zero_copy_only=False).tolist()])
        store.trim()
        which = tokens.indices.to_numpy()
        bounds = lists.offsets.to_numpy()
        bounds = bounds - bounds[0]
        marks = marks[which]
        sums = np.add.reduceat(marks[:, :4], bounds[:-1])
        worst = np.maximum.reduceat(marks[:, 4], bounds[:-1])
        telling = np.add.reduceat(marks[:, 5], bounds[:-1])
        same = np.r_[0, (which[1:] == which[:-1]) & (marks[1:, 0] > 0)].astype(np.float64)
        same[bounds[:-1]] = 0
        stutters = np.add.reduceat(same, bounds[:-1])
        n = np.maximum(sums[:, 0], 1)
        lines = []
        for text in part.to_pylist():
            full = [line for line in text.split("\n") if line.strip()]
            lines.append((len(full) - len(set(full))) / max(1, len(full)))
        shares = sums[:, 1:4] / n[:, None]
        rows.append(np.column_stack([shares, stutters / n, lines, np.log1p(sums[:, 0]), worst, np.minimum(telling, 5)]))
    return np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))


def _document_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good: Counter = Counter()
        bad: Counter = Counter()
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            (good if y else bad).update({bare(t) for t in (text.as_py() or "").split()})
        words = sorted(good.keys() | bad.keys())
        columns = [words, [good[w] for w in words], [bad[w] for w in words]]
        types = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["word", "g", "b"])


def fit(labelled: DataFrame, sample_docs: int = 8_000, words: int = 2_000, least: int = 10) -> Classifier:
    """A classifier of ``labelled`` (_y, _id, _text), on at most ``sample_docs`` rows and ``words``
    words that at least ``least`` sampled documents hold. Outcomes all alike, or none, give
    one without evidence."""
    count = labelled.count()
    if count > sample_docs:
        share = 1_050_000 * sample_docs // count
        labelled = labelled.filter(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) <= share).limit(sample_docs)
    sample = materialized(labelled.select("_y", "_text"))
    totals = sample.agg(F.coalesce(F.sum("_y"), F.lit(0)), F.count("*")).first()
    good, bad = totals[0], totals[1] - totals[0]
    if not good or not bad:
        return Classifier()
    counts = sample.mapInArrow(_document_words, "word string, g bigint, b bigint").groupBy("word")
    counts = counts.agg(F.sum("g").alias("g"), F.sum("b").alias("b")).filter(F.col("g") + F.col("b") >= least)
    ratio = F.log((F.col("b") + 0.5) / (bad + 1)) - F.log((F.col("g") + 0.5) / (good + 1))
    ranked = counts.select("word", ratio.alias("r"), (ratio * F.sqrt("b")).alias("z"))
    top = ranked.filter("r > 1 AND z > 6").orderBy(F.desc("z"), "word").limit(words).collect()
    model = Classifier(words={r["word"]: r["r"] for r in top if r["word"]})
    lexicon = model.words

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(lambda t: token_marks(lexicon, t), 200_000)
        for batch in batches:
            rows = features(batch.column(1), store)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows.tolist(), pa.list_(pa.float64()))], names=["_y", "x"]
            )

    rows = sample.mapInArrow(work, "_y int, x array<double>").collect()  # at most sample_docs
    x, y = np.array([r["x"] for r in rows]), np.array([r["_y"] for r in rows], np.float64)
    model.centre, model.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    x = np.column_stack([np.ones(len(x)), (x - model.centre) / model.scale])
    w, ridge = np.zeros(x.shape[1]), np.r_[0.0, np.ones(x.shape[1] - 1)]
    for _ in range(30):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        move = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    model.weights, model.base = w, float(np.log(good / bad))
    return model


def evidence(docs: DataFrame, model: Classifier) -> DataFrame:
    """_id and the evidence of every row of ``docs`` (_id, _text), within MOST_EVIDENCE."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        store = Store(lambda t: token_marks(model.words, t), 200_000)
        for batch in batches:
            x = (features(batch.column(1), store) - model.centre) / model.scale
            odds = model.weights[0] + x @ model.weights[1:] - model.base
            clipped = np.clip(odds, -MOST_EVIDENCE, MOST_EVIDENCE)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(clipped)], names=["_id", "evidence"])

    return docs.select("_id", "_text").mapInArrow(work, "_id bigint, evidence double")


def scored(
    docs: DataFrame, outcomes: DataFrame, sites: DataFrame, threshold: float = 0.5,
    text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """Key, ``host``, ``path``, ``site_prior``, ``evidence``, ``score`` (probability of being good)
    and ``kept`` of every row.

    ``outcomes``: doc_id and good (1, 0; null doesn't count; of several the least).
    ``sites``: doc_id, host, path; of several the smallest. A document without a site, or with a
    null key, has the global rate as its prior; null and empty texts are judged by their
    features, all 0. Without outcomes the prior is 0.5 and there is no evidence. Repeated rows
    are judged alike. No rows give no rows.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("_id"), F.col(text).alias("_text"))
    told = outcomes.filter("good IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_o"))
    told = materialized(told.agg(F.min("good").cast("int").alias("_y")))
    labelled = rows.join(told, F.col("_id") == F.col("_o")).select("_y", "_id", "_text")
    judged = materialized(evidence(rows, fit(labelled)))
    place = sites.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_s"))
    place = place.agg(F.min(F.struct("host", "path")).alias("site"))
    judged = judged.join(told, F.col("_id") == F.col("_o"), "left").join(place, F.col("_id") == F.col("_s"), "left")
    judged = materialized(judged.select("_id", "evidence", "_y", "site.host", "site.path"))

    # Counts by level, each document's label once.
    known = judged.filter("_y IS NOT NULL").dropDuplicates(["_id"])
    counts = [F.count("*").alias("n"), F.sum("_y").alias("k")]
    total = known.agg(*counts).first()
    rate = (total["k"] + 0.5) / (total["n"] + 1) if total["n"] else 0.5
    sited = known.filter("host IS NOT NULL")
    hosts = materialized(sited.groupBy("host").agg(*counts).withColumn("m", F.lit(rate)))
    s_host = prior_strength(hosts)
    hosts = hosts.select("host", F.col("n").alias("n_host"), F.col("k").alias("k_host"))
    paths = sited.groupBy("host", "path").agg(*counts).join(hosts, "host")
    above = (F.col("k_host") + rate * s_host) / (F.col("n_host") + s_host)
    paths = materialized(paths.withColumn("m", above))
    s_path = prior_strength(paths)

    hosts = hosts.withColumnRenamed("host", "_host")
    paths = paths.select(
        F.col("host").alias("_h"), F.col("path").alias("_p"), F.col("n").alias("n_path"), F.col("k").alias("k_path")
    )
    all_ = judged.join(broadcast_if_small(hosts), F.col("host") == F.col("_host"), "left")
    same = (F.col("host") == F.col("_h")) & F.col("path").eqNullSafe(F.col("_p"))
    all_ = all_.join(broadcast_if_small(paths), same, "left")
    own, one = F.coalesce("_y", F.lit(0)), F.when(F.col("_y").isNotNull(), 1).otherwise(0)

    def less(column: str, mine: Column) -> Column:
        return F.greatest(F.coalesce(F.col(column), F.lit(0)) - mine, F.lit(0))

    host = (less("k_host", own) + rate * s_host) / (less("n_host", one) + s_host)
    path = (less("k_path", own) + host * s_path) / (less("n_path", one) + s_path)
    prior = F.when(F.col("host").isNull(), F.lit(rate)).otherwise(path)
    all_ = all_.withColumn("site_prior", F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), prior)))
    odds = F.col("evidence") + F.log(F.col("site_prior") / (1 - F.col("site_prior")))
    score = 1 / (1 + F.exp(-odds))
    return all_.select(
        F.col("_id").alias(key), "host", "path", "site_prior", "evidence", score.alias("score"),
        (score >= threshold).alias("kept"),
    )
