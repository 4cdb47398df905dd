"""Prefix, wildcard and range clauses to the terms they match.

A pattern is looked up by its longest literal part:

``head``  what its terms start with, in the vocabulary, which is sorted by term
``tail``  what they end with, in the terms written backwards, sorted likewise
``gram``  two or three letters they hold, in a table of the grams of every term
``all``   a pattern without such a part meets every term

Few patterns are filters that a scan of the sorted table can use to skip; many are joined to it
on the literal part. Both look at whole terms at the end, so the look-up only has to be
complete.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termshard.operators.bounds import PUSHED_VALUES, broadcast_if_small

EXPANDED = ("prefix", "wildcard", "range")
GRAM_SIZES = (2, 3)


def backward_terms(vocabulary: DataFrame) -> DataFrame:
    """``(backward, term)`` of every distinct term."""
    terms = vocabulary.select("term").distinct()
    return terms.select(F.reverse("term").alias("backward"), "term")


def term_grams(vocabulary: DataFrame) -> DataFrame:
    """``(gram, term)``: the runs of two and of three letters of every distinct term."""

    def runs(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length("term") - (size - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.substring("term", i, F.lit(size)))

    grams = F.array_distinct(F.flatten(F.array(*map(runs, GRAM_SIZES))))
    return vocabulary.select("term").distinct().select(F.explode(grams).alias("gram"), "term")


def keyed(clauses: DataFrame) -> DataFrame:
    """The patterns among ``clauses`` with their ``path``, the literal ``key`` and, for wildcards,
    a regular expression."""
    rows = clauses.filter(F.col("kind").isin(*EXPANDED))
    # What both ends of a range start with; nothing if an end is open.
    shared = F.filter(
        F.sequence(F.lit(0), F.least(F.length("value"), F.length("upper"))),
        lambda n: F.left(F.col("value"), n) == F.left(F.col("upper"), n),
    )
    ends = F.coalesce(F.left(F.col("value"), F.array_max(shared)), F.lit(""))
    wild = F.col("kind") == "wildcard"
    literals = F.split("value", r"[*?]")
    longest = F.array_max(F.transform(literals, lambda x: F.struct(F.length(x).alias("n"), x.alias("run"))))
    rows = rows.withColumns(
        {
            "head": F.when(F.col("kind") == "range", ends).otherwise(F.regexp_extract("value", r"^[^*?]*", 0)),
            "tail": F.when(wild, F.regexp_extract("value", r"[^*?]*$", 0)).otherwise(F.lit("")),
            "gram": F.when(wild, F.left(longest["run"], F.lit(max(GRAM_SIZES)))).otherwise(F.lit("")),
        }
    )
    rows = rows.withColumn("head", F.when(F.col("kind") == "prefix", F.col("value")).otherwise(F.col("head")))
    head, tail, gram = (F.length(c) for c in ("head", "tail", "gram"))
    path = (
        F.when((gram >= min(GRAM_SIZES)) & (gram > F.greatest(head, tail)), F.lit("gram"))
        .when((tail > head), F.lit("tail"))
        .when((head > 0) | (F.col("kind") == "range"), F.lit("head"))
        .otherwise(F.lit("all"))
    )
    key = F.when(path == "gram", F.col("gram")).when(path == "tail", F.reverse("tail")).otherwise(F.col("head"))
    escaped = F.regexp_replace("value", r"([^\w*?])", r"\\$1")
    expression = F.replace(F.replace(escaped, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit("."))
    return rows.select(
        "query_id", "clause_id", "kind", "value", "upper", "exclude_value", "exclude_upper",
        path.alias("path"), key.alias("key"),
        F.when(wild, F.concat(F.lit("^"), expression, F.lit("$"))).alias("expression"),
    )


def _ends(term: Column, low, high, open_low, open_high) -> Column:
    """Whether a term lies in a range; a null end is open."""
    above = low.isNull() | F.when(open_low, term > low).otherwise(term >= low)
    below = high.isNull() | F.when(open_high, term < high).otherwise(term <= high)
    return above & below


def _pushed(row, column: str) -> Column:
    """The rows of a sorted table that one pattern may match, as a filter a scan can use."""
    at = F.col(column)
    if row["path"] == "gram":
        return at == row["key"]
    if row["kind"] != "range":
        return at.startswith(row["key"])
    low, high = row["value"], row["upper"]
    inside = [at >= low] if low is not None else []
    inside += [at <= high] if high is not None else []
    return reduce(lambda a, b: a & b, inside) if inside else F.lit(True)


def expand_patterns(
    clauses: DataFrame, vocabulary: DataFrame, backward: DataFrame | None = None,
    grams: DataFrame | None = None, few: int = PUSHED_VALUES,
) -> DataFrame:
    """``(query_id, clause_id, term)`` of the patterns among ``clauses``. ``backward`` and ``grams``
    are the stored tables of the vocabulary's terms, else they are made from it."""
    patterns = keyed(clauses)
    # A bounded look: the patterns themselves if they are few, else their paths and lengths.
    listed = patterns.limit(few + 1).collect()
    if len(listed) <= few:
        shapes = {(r["path"], len(r["key"])) for r in listed}
    else:
        seen = patterns.select("path", F.length("key").alias("n")).distinct().collect()
        shapes, listed = {(r["path"], r["n"]) for r in seen}, None
    side = broadcast_if_small(patterns)
    tables = {
        "head": (lambda: vocabulary.select("term").distinct(), "term"),
        "all": (lambda: vocabulary.select("term").distinct(), "term"),
        "tail": (lambda: backward_terms(vocabulary) if backward is None else backward, "backward"),
        "gram": (lambda: term_grams(vocabulary) if grams is None else grams, "gram"),
    }
    found = None
    for path in sorted({p for p, _ in shapes}):
        make, column = tables[path]
        terms = make()
        if listed is not None and path != "all":
            terms = terms.filter(reduce(or_, [_pushed(r, column) for r in listed if r["path"] == path]))
        if path == "gram":
            keys = F.array(F.col(column))
        else:
            sizes = [F.lit(n) for p, n in sorted(shapes) if p == path]
            fit = F.filter(F.array(*sizes), lambda n: n <= F.length(column))
            keys = F.transform(fit, lambda n: F.left(F.col(column), n))
        terms = terms.select("term", F.explode(keys).alias("key"))
        met = terms.join(side.filter(F.col("path") == path), "key")
        term = F.col("term")
        test = (
            F.when(F.col("kind") == "wildcard", F.rlike(term, F.col("expression")))
            .when(F.col("kind") == "range", _ends(term, *map(F.col, ("value", "upper", "exclude_value", "exclude_upper"))))
            .otherwise(F.lit(True))
        )
        rows = met.filter(test).select("query_id", "clause_id", "term")
        found = rows if found is None else found.unionByName(rows)
    return found
