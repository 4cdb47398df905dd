"""Full-text search over positional postings: BM25 and structured boolean clauses.

A clause is a row ``(query_id, clause_id, occur, kind, value, upper, boost, exclude_value,
exclude_upper, slop, parent)``:

``occur``  ``must``, ``should`` or ``must_not``
``kind``   ``term``, ``phrase``, ``prefix``, ``wildcard`` (``*`` any run, ``?`` one letter),
           ``range`` (``value`` to ``upper``; a null end is open, and ``exclude_value`` or
           ``exclude_upper`` leaves that end out), ``id`` (``theme_docid``), ``every`` (all
           documents) or ``group``
``slop``   how many other words a phrase may hold in all between its own, in their order
``parent`` the ``clause_id`` of the group a clause belongs to, of the query itself if null

Values other than ids are lower-cased. Terms and phrases are analysed as text is: a term of
several words needs them all, stop words and single letters are left out, and a clause with
nothing left is ignored, as is a group without clauses.

A document is a hit of a query or a group if it matches every ``must`` clause, at least one
``should`` clause if there is no ``must``, and no ``must_not`` clause. Terms and phrases score by
BM25, the other kinds score a constant 1, a group the sum of its clauses; each score is multiplied
by the boost. A query or group without ``must`` or ``should`` clauses has every other document as
a hit, with the score 1. Such a group as a ``must`` or ``must_not`` clause only restricts: it has no
score and counts as no ``must`` clause.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termshard.functions.display import document_key
from termshard.functions.tokens import ENGLISH_STOP_WORDS, drop_short, drop_words, indexed_words
from termshard.operators import impacts
from termshard.operators.bounds import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    broadcast_if_small,
    counted_values,
    listed,
    materialized,
    measured_size,
    one_of,
)
from termshard.operators.bow import DOCUMENT, shard_by_document, shards_for
from termshard.operators.document_terms import with_positions
from termshard.operators.patterns import EXPANDED, expand_patterns
from termshard.operators.phrases import phrase_hits
from termshard.operators.ranking import SUM_DIGITS, by_score, checked_count, top_n
from termshard.operators.skew import join_postings

DEFAULT_HITS = 10

# The BM25 parameters.
K1 = 1.2
B = 0.75

# Fixed value: what the full-text analyser takes as one word of a query.
QUERY_WORD = r"(?U)\w+(?:\.?\w+)*"

CLAUSE_SCHEMA = (
    "query_id bigint, clause_id int, occur string, kind string, value string, "
    "upper string, boost double, exclude_value boolean, exclude_upper boolean, slop int, parent int"
)
POSITIVE = ("must", "should")
OCCURS = ("must", "should", "must_not")
KINDS = ("term", "phrase", "id", "every", "group", *EXPANDED)
#: Of a query of must_not clauses alone, this many times the hits asked for are looked at first.
FIRST_OTHERS = 4


@dataclass(frozen=True)
class TextIndex:
    """``postings (theme, term, doc_id, tf, positions, dl)``, ``vocabulary (theme, term, df,
    cf)``, ``doc_stats (theme, doc_id, dl)`` and ``corpus_stats (theme, n_docs, avg_dl)``; for
    patterns, if stored, the terms ``backward (backward, term)`` and their ``grams (gram,
    term)``, of all themes; for large batches the impact ``levels`` of the words."""

    postings: DataFrame
    vocabulary: DataFrame
    doc_stats: DataFrame
    corpus_stats: DataFrame
    backward: DataFrame | None = None
    grams: DataFrame | None = None
    levels: DataFrame | None = None

    def only(self, theme: str) -> TextIndex:
        here = F.col("theme") == theme
        return TextIndex(
            self.postings.filter(here),
            self.vocabulary.filter(here),
            self.doc_stats.filter(here),
            self.corpus_stats.filter(here),
            self.backward,
            self.grams,
            None if self.levels is None else self.levels.filter(here),
        )


def text_postings(tokens: DataFrame, shards: int | None = None) -> DataFrame:
    """Positions count the words the analyser keeps, so a phrase may span a left-out word."""
    return _positions(kept_words(tokens), shards)


def kept_words(tokens: DataFrame) -> DataFrame:
    return tokens.select(*DOCUMENT, indexed_words(F.col("tokens")).alias("tokens"))


def _positions(words: DataFrame, shards: int | None) -> DataFrame:
    return with_positions(shard_by_document(words, shards))


def text_doc_stats(tokens: DataFrame) -> DataFrame:
    return _lengths(kept_words(tokens))


def _lengths(words: DataFrame) -> DataFrame:
    return words.select(*DOCUMENT, F.size("tokens").cast("bigint").alias("dl"))


def corpus_stats(doc_stats: DataFrame) -> DataFrame:
    """``(theme, n_docs, avg_dl)``; documents without words count."""
    return doc_stats.groupBy("theme").agg(
        F.count("*").alias("n_docs"), F.avg("dl").alias("avg_dl")
    )


def text_index(tokens: DataFrame) -> TextIndex:
    """Postings and vocabulary are stored, as every step of a search reads them again."""
    words = materialized(kept_words(tokens))
    shards = shards_for(words)
    stored = materialized(_positions(words, shards))
    vocabulary = stored.groupBy("theme", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
    stats = materialized(_lengths(words))
    return TextIndex(stored.repartition(shards, "doc_id"), materialized(vocabulary), stats, corpus_stats(stats))


def term_part(postings: DataFrame, stats: DataFrame) -> tuple[DataFrame, Column]:
    """Postings with the average length of their theme, and what BM25 makes of a posting but for
    the weight of its word."""
    length = K1 * ((1 - B) + B * F.col("dl") / F.col("avg_dl"))
    part = F.col("tf") * (K1 + 1) / (F.col("tf") + length)
    return postings.join(F.broadcast(stats.select("theme", "avg_dl")), "theme"), part


def bm25_levels(postings: DataFrame, stats: DataFrame) -> DataFrame:
    return impacts.impact_levels(*term_part(postings, stats))


def query_words(text: Column) -> Column:
    """The words of raw query text: lower-cased, stop words and single letters left out."""
    words = F.regexp_extract_all(F.lower(text), F.lit(QUERY_WORD), F.lit(0))
    return drop_words(drop_short(words), ENGLISH_STOP_WORDS)


def text_clauses(queries: DataFrame, occur: str = "must") -> DataFrame:
    """Clauses of plain text queries ``(query_id, text)``: every word once, all required."""
    words = F.array_distinct(query_words(F.col("text")))
    return queries.select("query_id", F.posexplode(words).alias("clause_id", "value")).select(
        "query_id",
        "clause_id",
        F.lit(occur).alias("occur"),
        F.lit("term").alias("kind"),
        "value",
        F.lit(None).cast("string").alias("upper"),
        F.lit(1.0).alias("boost"),
    )


def clauses_table(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    """Clauses from dicts; all but ``query_id`` have defaults, and all but groups and ``every``
    need a ``value``."""
    rows = list(rows)
    filled = [
        (
            r["query_id"], r.get("clause_id", i), r.get("occur", "must"), r.get("kind", "term"),
            r.get("value"), r.get("upper"), float(r.get("boost", 1.0)),
            bool(r.get("exclude_value")), bool(r.get("exclude_upper")),
            int(r.get("slop", 0)), r.get("parent"),
        )
        for i, r in enumerate(rows)
    ]
    for _, _, occur, kind, *_ in filled:
        if occur not in OCCURS:
            raise ValueError(f"unknown occur {occur!r}")
        if kind not in KINDS:
            raise ValueError(f"unknown clause kind {kind!r}")
    return spark.createDataFrame(filled, CLAUSE_SCHEMA)


def analysed_clauses(clauses: DataFrame) -> DataFrame:
    """Clauses with lower-cased values and their ``words``, less those without any."""
    missing = {"exclude_value": F.lit(False), "exclude_upper": F.lit(False), "slop": F.lit(0),
               "parent": F.lit(None).cast("int")}
    clauses = clauses.withColumns({c: v for c, v in missing.items() if c not in clauses.columns})
    is_text, is_id = F.col("kind").isin("term", "phrase"), F.col("kind") == "id"
    words = query_words(F.coalesce("value", F.lit("")))
    words = F.when(F.col("kind") == "term", F.array_distinct(words)).otherwise(words)
    lowered = {c: F.when(is_id, F.col(c)).otherwise(F.lower(c)) for c in ("value", "upper")}
    return clauses.withColumn("words", words).withColumns(lowered).filter(
        ~is_text | (F.size("words") > 0)
    )


@dataclass(frozen=True)
class _Shape:
    """What one look at the clauses tells."""

    rows: int
    kinds: frozenset[str]
    slops: bool
    nested: bool
    complements: bool  # whether a query may have what it doesn't ask for as hits


def _shape_of(clauses: DataFrame) -> _Shape:
    row = clauses.agg(
        F.count("*").alias("rows"),
        F.collect_set("kind").alias("kinds"),
        F.coalesce(F.max(F.col("slop") > 0), F.lit(False)).alias("slops"),
        F.coalesce(F.max(F.col("parent").isNotNull()), F.lit(False)).alias("nested"),
        F.coalesce(F.max(F.col("occur") == "must_not"), F.lit(False)).alias("nots"),
    ).first()
    kinds = frozenset(row["kinds"])
    nested = row["nested"] or "group" in kinds
    return _Shape(row["rows"], kinds, row["slops"], nested, row["nots"] or "every" in kinds)


def _wanted_terms(clauses: DataFrame, shape: _Shape, index: TextIndex) -> DataFrame:
    """One row per clause and term to look up, with the place of the term in a phrase."""
    keys = ["query_id", "clause_id"]
    wanted = clauses.filter(F.col("kind").isin("term", "phrase")).select(
        *keys, F.size("words").alias("words"), F.posexplode("words").alias("offset", "term")
    )
    if not shape.kinds & set(EXPANDED):
        return wanted
    expanded = expand_patterns(clauses, index.vocabulary, index.backward, index.grams)
    if expanded is None:
        return wanted
    return wanted.unionByName(
        expanded.select(*keys, F.lit(1).alias("words"), F.lit(0).alias("offset"), "term")
    )


def _weights(
    wanted: DataFrame, clauses: DataFrame, vocabulary: DataFrame, corpus_stats: DataFrame
) -> DataFrame:
    """Per theme what the terms of the clauses weigh: idf and average length."""
    idf = F.log(F.col("n_docs") / (F.col("df") + 1)) + 1
    head = clauses.select("query_id", "clause_id", "kind", "boost", "slop")
    return (
        vocabulary.join(wanted, "term")
        .join(corpus_stats, "theme")
        .join(head, ["query_id", "clause_id"])
        .select(
            "query_id", "clause_id", "theme", "term", "offset", "words", "kind", "boost", "slop",
            idf.alias("idf"), "avg_dl",
        )
    )


def _clause_hits(
    clauses: DataFrame, shape: _Shape, index: TextIndex, limit: int | None, small: bool | None
) -> DataFrame:
    """``(query_id, theme, doc_id, clause_id, score)``: the documents each clause matches.

    Every grouping has the document among its keys and stays in the partition of the
    document.
    """
    wanted = _wanted_terms(clauses, shape, index)
    if shape.kinds & set(EXPANDED):
        wanted = materialized(wanted)
    rows, terms = counted_values(wanted, "term")
    if small is None:
        themes = max(index.corpus_stats.count(), 1)
        size = measured_size(wanted)[1] if terms is None else 0  # listed terms are few
        small = rows * themes <= BROADCAST_ROWS and size * themes <= BROADCAST_BYTES
    postings, vocabulary, corpus = index.postings, index.vocabulary, index.corpus_stats
    if terms is not None:
        postings = postings.filter(one_of("term", terms))
        vocabulary = vocabulary.filter(one_of("term", terms))
    if small:
        # The clauses are no more than the terms wanted, but for those without any.
        wanted, corpus = F.broadcast(wanted), F.broadcast(corpus)
    weights = _weights(wanted, clauses, vocabulary, corpus)
    length = K1 * ((1 - B) + B * F.col("dl") / F.col("avg_dl"))
    bm25 = F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + length)
    constant = F.col("kind").isin(*EXPANDED)
    found = join_postings(postings, weights, vocabulary, small, limit).select(
        "query_id", "theme", "doc_id", "clause_id", "kind", "words", "slop", "offset", "positions",
        (F.col("boost") * F.when(constant, F.lit(1.0)).otherwise(bm25)).alias("score"),
    )
    keys = ["query_id", "theme", "doc_id", "clause_id"]
    best = F.max("score").alias("score")
    single = found.filter("words = 1").groupBy(*keys).agg(best)
    if "term" in shape.kinds:
        every = found.filter("words > 1 AND kind = 'term'").groupBy(*keys, "words")
        every = every.agg(F.count("*").alias("matched"), F.sum("score").alias("score"))
        single = single.unionByName(every.filter("matched = words").select(*keys, "score"))
    if "phrase" not in shape.kinds:
        return single
    phrases = found.filter("words > 1 AND kind = 'phrase'")
    return single.unionByName(phrase_hits(phrases, keys, shape.slops))


def _id_hits(clauses: DataFrame, index: TextIndex) -> DataFrame:
    ids = clauses.filter("kind = 'id'").select(
        "query_id",
        "clause_id",
        F.regexp_extract("value", r"^(.*)_\d+$", 1).alias("theme"),
        F.regexp_extract("value", r"_(\d+)$", 1).try_cast("bigint").alias("doc_id"),
        F.col("boost").alias("score"),
    )
    found = index.doc_stats.select(*DOCUMENT)
    keys = listed(ids, "doc_id")
    if keys is not None:
        found = found.filter(one_of("doc_id", keys, ranges=False))
    return ids.join(found, list(DOCUMENT)).select(
        "query_id", "theme", "doc_id", "clause_id", "score"
    )


def _with_effect(clauses: DataFrame) -> DataFrame:
    """The clauses with their ``depth`` in the tree and their ``effect``: must, should, must_not, or
    require, which is a must that neither scores nor counts as one. Groups without clauses are left
    out.

    A group is ``plain`` if no clause of it is a must or should. Then it is the ``complement`` of
    what it bans, unless something in it is required. To ban a complement is to require what it
    bans, so complements are made only where one is a should clause.
    """
    key = ["query_id", "clause_id"]
    level = materialized(clauses.filter("parent IS NULL"))
    levels, total = [level], level.count()
    while True:
        groups = level.filter("kind = 'group'").select("query_id", F.col("clause_id").alias("parent"))
        level = materialized(clauses.join(groups, ["query_id", "parent"]))
        n = level.count()
        if not n:
            break
        levels.append(level)
        total += n
    if total != clauses.count():
        raise ValueError("a clause belongs to no group of its query, or groups to each other")
    done, below = None, None
    for depth in reversed(range(len(levels))):
        rows = levels[depth].withColumn("depth", F.lit(depth))
        if below is None:
            rows = rows.filter("kind <> 'group'").withColumns({"plain": F.lit(False), "complement": F.lit(False)})
        else:
            rows = rows.join(below, key, "left").filter("kind <> 'group' OR positive IS NOT NULL")
            rows = rows.withColumns(
                {"plain": F.expr("coalesce(NOT positive, false)"),
                 "complement": F.expr("coalesce(NOT positive AND NOT requires, false)")}
            )
        effect = F.expr(
            "CASE WHEN NOT plain OR occur = 'should' THEN occur "
            "WHEN (occur = 'must') = complement THEN 'must_not' ELSE 'require' END"
        )
        rows = rows.withColumn("effect", effect).select(*clauses.columns, "depth", "plain", "complement", "effect")
        done = rows if done is None else done.unionByName(rows)
        below = (
            rows.filter("parent IS NOT NULL")
            .groupBy("query_id", F.col("parent").alias("clause_id"))
            .agg(
                F.max(F.col("effect").isin(*POSITIVE)).alias("positive"),
                F.max(F.col("effect") == "require").alias("requires"),
            )
        )
    return materialized(done)


def _combined(hits: DataFrame, needs: DataFrame, small: bool) -> DataFrame:
    """Hits of clauses to ``(query_id, parent, theme, doc_id, holds, banned, score)``."""
    positive = F.col("effect").isin(*POSITIVE)

    def number(of: str):
        return F.sum((F.col("effect") == of).cast("int"))

    met = (
        hits.join(F.broadcast(needs) if small else needs, ["query_id", "clause_id"])
        .groupBy("query_id", "parent", "theme", "doc_id")
        .agg(
            F.max("musts").alias("musts"), number("must").alias("matched"),
            F.max("requires").alias("requires"), number("require").alias("required"),
            number("must_not").alias("banned"),
            F.max("wants").alias("wants"), F.sum(positive.cast("int")).alias("positive"),
            F.sum(F.when(positive, F.col("score"))).alias("score"),
        )
    )
    holds = F.expr("matched = musts AND required = requires AND banned = 0 AND (positive > 0 OR NOT wants)")
    return met.select(
        "query_id", "parent", *DOCUMENT, holds.alias("holds"), (F.col("banned") > 0).alias("banned"),
        F.when(F.col("wants"), F.col("score")).otherwise(F.lit(1.0)).alias("score"),
    )


def _everywhere(asked: DataFrame, index: TextIndex) -> DataFrame:
    """Every document of every theme for each row of ``asked``; one name per theme is listed."""
    themes = sorted(r["theme"] for r in index.corpus_stats.select("theme").collect())
    if not themes:
        asked = asked.filter(F.lit(False))
    each = asked.withColumn("theme", F.explode(F.array(*map(F.lit, themes or [""]))))
    return broadcast_if_small(each).join(index.doc_stats.select(*DOCUMENT), "theme")


def _leaf_hits(
    clauses: DataFrame, shape: _Shape, index: TextIndex, limit: int | None, small: bool | None
) -> DataFrame:
    """``(query_id, theme, doc_id, clause_id, score)`` of all clauses that aren't groups."""
    columns = ["query_id", "theme", "doc_id", "clause_id", "score"]
    parts = []
    if shape.kinds & {"term", "phrase", *EXPANDED}:
        parts.append(_clause_hits(clauses, shape, index, limit, small))
    if "id" in shape.kinds:
        parts.append(_id_hits(clauses, index))
    if "every" in shape.kinds:
        every = clauses.filter("kind = 'every'").select("query_id", "clause_id", F.col("boost").alias("score"))
        parts.append(_everywhere(every, index).select(*columns))
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    return hits


def _evaluated(
    clauses: DataFrame, shape: _Shape, index: TextIndex, limit: int | None, small: bool | None
) -> DataFrame:
    """``_combined`` of the clauses at the top, groups evaluated level by level from the deepest.
    ``clauses`` have an effect."""
    hits = _leaf_hits(clauses, shape, index, limit, small)
    siblings = Window.partitionBy("query_id", "parent")
    effect = F.col("effect")
    needs = clauses.select(
        "query_id", "clause_id", "parent", "effect",
        F.sum((effect == "must").cast("int")).over(siblings).alias("musts"),
        F.sum((effect == "require").cast("int")).over(siblings).alias("requires"),
        F.max(effect.isin(*POSITIVE)).over(siblings).alias("wants"),
        *(["depth", "plain", "complement", "boost", "kind", "occur"] if shape.nested else []),
    )
    few = shape.rows <= BROADCAST_ROWS
    if not shape.nested:
        return _combined(hits, needs, few)
    hits, needs = materialized(hits), materialized(needs)
    base = ["query_id", "clause_id", "parent", "effect", "musts", "requires", "wants"]
    groups = needs.filter("kind = 'group'").select(
        "query_id", F.col("clause_id").alias("parent"), "plain", "complement", "occur", "boost"
    )
    groups = F.broadcast(groups) if few else groups
    upper = None
    for depth in range(needs.agg(F.max("depth")).first()[0] or 0, 0, -1):
        level = hits if upper is None else hits.unionByName(upper)
        met = _combined(level, needs.filter(F.col("depth") == depth).select(*base), few)
        met = met.join(groups, ["query_id", "parent"]).filter("IF(complement, banned, holds)")
        own = ["query_id", *DOCUMENT, F.col("parent").alias("clause_id")]
        score = F.when(F.expr("plain AND occur <> 'should'"), F.lit(0.0)).otherwise(F.col("score") * F.col("boost"))
        turned = F.expr("complement AND occur = 'should'")
        upper = met.filter(~turned).select(*own, score.alias("score"))
        others = needs.filter((F.col("depth") == depth - 1) & F.expr("kind = 'group'") & turned)
        if not others.isEmpty():
            rows = _everywhere(others.select("query_id", "clause_id", F.col("boost").alias("score")), index)
            rows = rows.join(met.filter(turned).select(*own), ["query_id", "clause_id", *DOCUMENT], "left_anti")
            upper = upper.unionByName(rows.select("query_id", *DOCUMENT, "clause_id", "score"))
    level = hits if upper is None else hits.unionByName(upper)
    return _combined(level, needs.filter("depth = 0").select(*base), few)


def _first_others(asked: DataFrame, banned: DataFrame, index: TextIndex, limit: int) -> DataFrame:
    """Of each query of ``asked`` (query_id, score) and theme the ``limit`` documents with the smallest
    ids that ``banned`` (query_id, theme, doc_id) doesn't hold.

    The smallest ids of a theme decide: some are looked at, and more only for queries that ban so
    many of them that too few are left. As many as a query bans, and ``limit``, are always enough.
    """
    banned = materialized(banned.distinct())
    most = banned.groupBy("query_id", "theme").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    themes = sorted(r["theme"] for r in index.corpus_stats.select("theme").collect())
    if not themes:
        asked = asked.filter(F.lit(False))
    left = asked.withColumn("theme", F.explode(F.array(*map(F.lit, themes or [""]))))
    done, size = None, FIRST_OTHERS * limit
    while True:
        size = min(size, limit + most)
        first = top_n(index.doc_stats.select(*DOCUMENT), size, ["theme"], [F.col("doc_id")], rank="place")
        first = materialized(first.drop("place"))
        rows = broadcast_if_small(left).join(first, "theme")
        rows = rows.join(banned, ["query_id", *DOCUMENT], "left_anti")
        rows = materialized(top_n(rows, limit, ["query_id", "theme"], [F.col("doc_id")], rank="place"))
        part = rows.select("query_id", *DOCUMENT, "score")
        if size == limit + most:
            return part if done is None else done.unionByName(part)
        # Complete: enough documents, or a theme that has no more than were looked at.
        enough = rows.groupBy("query_id", "theme").agg(F.count("*").alias("n")).filter(F.col("n") == limit)
        whole = first.groupBy("theme").agg(F.count("*").alias("n")).filter(F.col("n") < size).select("theme")
        open_ = left.join(enough.select("query_id", "theme"), ["query_id", "theme"], "left_anti")
        open_ = materialized(open_.join(whole, "theme", "left_anti"))
        part = part.join(open_.select("query_id", "theme"), ["query_id", "theme"], "left_anti")
        done = part if done is None else done.unionByName(part)
        if open_.isEmpty():
            return done
        left, size = open_, 8 * size


def _complements(
    clauses: DataFrame, shape: _Shape, index: TextIndex, limit: int | None, small: bool | None, first: int | None
) -> tuple[DataFrame, _Shape, DataFrame | None]:
    """The hits of the queries that ban only, or ask for every document and nothing else, which the
    clauses at the top tell; and the other queries' clauses. Either side is evaluated once."""
    every, plus = F.col("kind") == "every", F.col("effect").isin(*POSITIVE)
    asks = (plus & ~every) | (F.col("effect") == "require")
    judged = clauses.filter("parent IS NULL").groupBy("query_id").agg(
        F.max(asks).alias("positive"),
        F.sum(F.when(every & plus, F.col("boost"))).alias("score"),
        F.max(every & ~plus).alias("nothing"),
    )
    own = materialized(
        judged.filter("NOT positive").select("query_id", F.coalesce("score", F.lit(1.0)).alias("score"), "nothing")
    )
    if own.isEmpty():
        return clauses, shape, None
    ids = broadcast_if_small(own.select("query_id"))
    bans = clauses.join(ids, "query_id", "left_semi").filter("kind <> 'every' OR parent IS NOT NULL")
    rest = clauses.join(ids, "query_id", "left_anti")
    bans_shape, rest_shape = (replace(_shape_of(c), nested=shape.nested) for c in (bans, rest))
    asked = own.filter("NOT nothing").select("query_id", "score")
    if bans_shape.kinds - {"group"}:
        banned = _evaluated(bans, bans_shape, index, limit, small).filter("banned")
        banned = banned.select("query_id", *DOCUMENT)
    else:
        none = index.doc_stats.filter(F.lit(False)).select(*DOCUMENT)
        banned = none.withColumn("query_id", F.lit(None).cast("bigint"))
    if first is not None:
        found = _first_others(asked, banned, index, first)
    else:
        found = _everywhere(asked, index).join(banned, ["query_id", *DOCUMENT], "left_anti")
    return rest, rest_shape, found.select("query_id", "theme", "doc_id", "score")


def matches(
    clauses: DataFrame,
    index: TextIndex,
    limit: int | None = None,
    small: bool | None = None,
    first: int | None = None,
) -> DataFrame:
    """``(query_id, theme, doc_id, score)`` of every hit, unranked. ``small``: whether the query
    side may be broadcast; it is measured if not given. With ``first``, queries whose hits all
    score the same give that many a theme, those with the smallest ids."""
    if clauses.isEmpty():
        raise ValueError("there are no clauses")
    clauses = analysed_clauses(clauses)
    shape = _shape_of(clauses)
    if shape.nested:
        clauses = _with_effect(clauses)
        shape = replace(_shape_of(clauses), nested=True)
    else:
        clauses = clauses.withColumn("effect", F.col("occur"))
    found = None
    if shape.complements:
        clauses, shape, found = _complements(clauses, shape, index, limit, small, first)
    if shape.kinds - {"group"}:
        hits = _evaluated(clauses, shape, index, limit, small)
        hits = hits.filter("holds").select("query_id", "theme", "doc_id", "score")
        found = hits if found is None else hits.unionByName(found)
    if found is None:  # every clause was ignored
        nothing = index.doc_stats.filter(F.lit(False)).select(*DOCUMENT)
        found = nothing.select(F.lit(None).cast("bigint").alias("query_id"), *DOCUMENT, F.lit(1.0).alias("score"))
    return found


def _can_be_best(
    clauses: DataFrame, index: TextIndex, limit: int, small: bool | None, prune: bool | None
) -> DataFrame | None:
    """Of queries of ``should`` words alone the documents that can be among the best, by impact
    bounds; nothing where other clauses occur or where it isn't worth it."""
    given = analysed_clauses(clauses)
    plain = F.expr("kind = 'term' AND occur = 'should' AND size(words) = 1 AND boost >= 0 AND parent IS NULL")
    rows = given.agg(F.count("*").alias("n"), F.min(plain).alias("plain")).first()
    if not rows["plain"] or not (prune or rows["n"] >= impacts.BATCH_WORDS):
        return None
    few = rows["n"] * max(index.corpus_stats.count(), 1) <= BROADCAST_ROWS and small is not False
    words = given.select("query_id", "clause_id", F.size("words").alias("words"), F.lit(0).alias("offset"),
                         F.col("words")[0].alias("term"))
    weights = _weights(words, given, index.vocabulary, index.corpus_stats)
    weights = weights.select("query_id", "theme", "term", (F.col("boost") * F.col("idf")).alias("weight"))
    weights = weights.groupBy("query_id", "theme", "term").agg(F.sum("weight").alias("weight"))
    levels = bm25_levels(index.postings, index.corpus_stats) if index.levels is None else index.levels
    bounds = materialized(impacts.bounded(weights, levels, limit, few))
    if not prune and not impacts.is_worth_it(bounds):
        return None
    postings, part = term_part(index.postings, index.corpus_stats)
    return impacts.candidates(postings, part, bounds, index.vocabulary, limit, few)


def search(
    clauses: DataFrame,
    index: TextIndex,
    limit: int = DEFAULT_HITS,
    theme: str | None = None,
    small: bool | None = None,
    prune: bool | None = None,
) -> DataFrame:
    """The best ``limit`` hits of each query in every theme, or in one. ``prune``: whether to find
    by impact bounds which documents can be among them; large batches of ``should`` words do."""
    checked_count(limit)
    chosen = index if theme is None else index.only(theme)
    order = [by_score("score", SUM_DIGITS), F.col("doc_id")]
    best = None if prune is False else _can_be_best(clauses, chosen, limit, small, prune)
    fewer = None if best is None else impacts.only_documents(chosen.postings, best)
    if fewer is not None:
        chosen = replace(chosen, postings=fewer)
    found = matches(clauses, chosen, small=small, first=limit)
    if fewer is not None:
        found = impacts.only_found(found, best)
    hits = top_n(found, limit, ["query_id", "theme"], order)
    return hits.select(
        "query_id",
        document_key(F.col("theme"), F.col("doc_id")).alias("id"),
        "theme",
        "doc_id",
        "score",
        "rank",
    )


def search_text(
    queries: DataFrame,
    index: TextIndex,
    limit: int = DEFAULT_HITS,
    theme: str | None = None,
) -> DataFrame:
    """Plain text queries, all words required."""
    return search(text_clauses(queries), index, limit, theme)
