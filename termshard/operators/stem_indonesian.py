"""Indonesian stemming by confix stripping against a table of root words.

After Adriani, Asian, Nazief, Tahaghoghi and Williams, "Stemming Indonesian: a
confix-stripping approach", ACM TALIP 6(4), 2007. Every word yields an array of candidates:
with and without its particle, possessive and suffix, then with up to three prefixes taken
off, then without an infix after the first consonant. The candidate that is a root and comes
first in the order of stripping is the stem; a word without such a candidate stays as it is.

The contract is these rules and the caller's roots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termshard.operators.bounds import materialized
from termshard.operators.skew import join_by_term

MIN_STEM_LENGTH = 2
SHORTEST_STEMMED = 4
MAX_PREFIXES = 3

# The endings, outermost first.
PARTICLES = ("lah", "kah", "tah", "pun")
POSSESSIVES = ("ku", "mu", "nya")
SUFFIXES = ("i", "kan", "an", "is", "isme", "isasi")

# Infixes, between the first consonant of a word and a vowel.
INFIXES = ("er", "el", "em", "in")

# Prefix families and what each form leaves of the word, by pattern.
PREFIX_RULES = (
    ("di", "^di(..)", "$1"),
    ("ke", "^ke(..)", "$1"),
    ("se", "^se(..)", "$1"),
    ("be", "^ber([aiueo])", "$1"),
    ("be", "^be(r[aiueo])", "$1"),
    ("be", "^ber([^aiueor])", "$1"),
    ("be", "^bel(ajar)$", "$1"),
    ("be", "^be([^aiueorl]er[^aiueo])", "$1"),
    ("te", "^ter([aiueo])", "$1"),
    ("te", "^te(r[aiueo])", "$1"),
    ("te", "^ter([^aiueor])", "$1"),
    ("te", "^te([^aiueor]er[^aiueo])", "$1"),
    ("me", "^me([lrwy][aiueo])", "$1"),
    ("me", "^mem([bfv])", "$1"),
    ("me", "^mem(pe)", "$1"),
    ("me", "^mem(p[^e])", "$1"),
    ("me", "^me(mr?[aiueo])", "$1"),
    ("me", "^mem(r?[aiueo])", "p$1"),
    ("me", "^men([cdjszt])", "$1"),
    ("me", "^me(n[aiueo])", "$1"),
    ("me", "^men([aiueo])", "t$1"),
    ("me", "^meng([ghqk])", "$1"),
    ("me", "^meng([aiueo])", "$1"),
    ("me", "^meng([aiueo])", "k$1"),
    ("me", "^menge([^aiueo])", "$1"),
    ("me", "^me(ny[aiueo])", "$1"),
    ("me", "^meny([aiueo])", "s$1"),
    ("pe", "^pe([wy][aiueo])", "$1"),
    ("pe", "^per([aiueo])", "$1"),
    ("pe", "^pe(r[aiueo])", "$1"),
    ("pe", "^per([^aiueor])", "$1"),
    ("pe", "^pem([bfv])", "$1"),
    ("pe", "^pe(mr?[aiueo])", "$1"),
    ("pe", "^pem(r?[aiueo])", "p$1"),
    ("pe", "^pen([cdjz])", "$1"),
    ("pe", "^pe(n[aiueo])", "$1"),
    ("pe", "^pen([aiueo])", "t$1"),
    ("pe", "^peng([ghq])", "$1"),
    ("pe", "^peng([aiueo])", "$1"),
    ("pe", "^peng([aiueo])", "k$1"),
    ("pe", "^penge([^aiueo])", "$1"),
    ("pe", "^pe(ny[aiueo])", "$1"),
    ("pe", "^peny([aiueo])", "s$1"),
    ("pe", "^pel(ajar)$", "$1"),
    ("pe", "^pe(l[aiueo])", "$1"),
    ("pe", "^pe([^aiueorwylmn]er[aiueo])", "$1"),
    ("pe", "^pe([^aiueorwylmn][^e])", "$1"),
    ("ku", "^ku(..)", "$1"),
    ("ka", "^kau(..)", "$1"),
)

# Prefix and suffix that no word takes together.
FORBIDDEN = ("be-i", "di-an", "ke-i", "ke-kan", "me-an", "se-i", "se-kan", "te-an")

# Words of these shapes lose their prefix before their endings.
PREFIX_FIRST = "^(?:be.+lah|be.+an|me.+i|di.+i|pe.+i|te.+i)$"


# A candidate, with the SQL of its fields.
FIELDS = ("form", "suffix", "stripped", "family", "prefixes", "path")


def _candidate(form: str, **changed: str) -> str:
    values = {f: f"c.{f}" for f in FIELDS} | {"form": form} | changed
    return f"struct({', '.join(f'{v} AS {f}' for f, v in values.items())})"


def _grow(candidates: str, options: str) -> str:
    """Each candidate followed by what ``options`` makes of it, the too short ones dropped."""
    grown = f"flatten(transform({candidates}, c -> concat(array(c), {options})))"
    return f"filter({grown}, c -> length(c.form) >= {MIN_STEM_LENGTH})"


def _without_ending(endings: tuple[str, ...], is_suffix: bool) -> str:
    listed = ", ".join(f"'{e}'" for e in endings)
    shorter = _candidate(
        "left(c.form, length(c.form) - length(e))",
        suffix="e" if is_suffix else "c.suffix",
        stripped="c.stripped + 1",
    )
    return f"transform(filter(array({listed}), e -> endswith(c.form, e)), e -> {shorter})"


def _rules_map() -> str:
    """Prefix family to its rules, numbered in order."""
    families: dict[str, list[str]] = {}
    for n, (family, pattern, left) in enumerate(PREFIX_RULES, 1):
        rule = f"struct('{pattern}' AS pattern, '{left}' AS left, {n} AS n)"
        families.setdefault(family, []).append(rule)
    return ", ".join(f"'{f}', array({', '.join(rules)})" for f, rules in families.items())


def _without_prefix(round_no: int) -> str:
    """One more prefix off candidates that have lost ``round_no - 1``; no family twice running."""
    ready = f"c.prefixes = {round_no - 1} AND c.family <> left(c.form, 2)"
    if round_no == 1:
        banned = ", ".join(f"'{pair}'" for pair in FORBIDDEN)
        ready += f" AND concat(left(c.form, 2), '-', c.suffix) NOT IN ({banned})"
    usable = f"CASE WHEN {ready} THEN map({_rules_map()})[left(c.form, 2)] END"
    stripped = _candidate(
        "regexp_replace(c.form, r.pattern, r.left)",
        family="left(c.form, 2)",
        prefixes=str(round_no),
        path="c.path * 100 + r.n",
    )
    matching = f"filter({usable}, r -> c.form RLIKE r.pattern)"
    return f"coalesce(transform({matching}, r -> {stripped}), array())"


def _without_infix() -> str:
    listed = ", ".join(
        f"struct('^([^aiueo]){infix}([aiueo])' AS pattern, {n} AS n)"
        for n, infix in enumerate(INFIXES, len(PREFIX_RULES) + 1)
    )
    shorter = _candidate(
        "regexp_replace(c.form, r.pattern, '$1$2')", prefixes="c.prefixes + 1", path="c.path * 100 + r.n"
    )
    return f"transform(filter(array({listed}), r -> c.form RLIKE r.pattern), r -> {shorter})"


def _bare(term: str) -> str:
    first = _candidate(
        term, suffix="''", stripped="0", family="''", prefixes="0", path="CAST(0 AS BIGINT)"
    )
    return f"array({first})"


def candidates(term: str) -> Column:
    """All candidates of the word in a column, the word itself among them."""
    grown = _bare(term)
    for endings, is_suffix in ((PARTICLES, False), (POSSESSIVES, False), (SUFFIXES, True)):
        grown = _grow(grown, _without_ending(endings, is_suffix))
    for round_no in range(1, MAX_PREFIXES + 1):
        grown = _grow(grown, _without_prefix(round_no))
    grown = _grow(grown, _without_infix())
    return F.expr(
        f"CASE WHEN length({term}) >= {SHORTEST_STEMMED} THEN {grown} ELSE {_bare(term)} END"
    )


def _order(term: Column, c: Column) -> Column:
    """Endings off first, then prefixes off the barest form, then off the fuller ones; words
    of the prefix-first shapes try their prefixes with all endings on before that."""
    prefix_first = term.rlike(PREFIX_FIRST) & (c["stripped"] == 0) & (c["prefixes"] > 0)
    step = (
        F.when((c["prefixes"] == 0) & (c["stripped"] == 0), 0)
        .when(prefix_first, c["prefixes"])
        .when(c["prefixes"] == 0, 10 + c["stripped"])
        .otherwise(20 + (3 - c["stripped"]) * 5 + c["prefixes"])
    )
    return F.struct(step.alias("step"), c["path"].alias("path"), c["form"].alias("form"))


def with_indonesian_stem(
    words: DataFrame, roots: DataFrame, roots_fit: bool, term: str = "term", stem: str = "id_stem",
    hot: int | None = None,
) -> DataFrame:
    """Add the stem of each distinct word.

    With roots that fit a broadcast there is no shuffle: the words are already partitioned by
    themselves. Beyond that the forms are looked up by shuffle; those that most words share, short
    ones mostly, roots or not, are served by a broadcast apart (``hot``: those of more words).
    """
    others = [c for c in words.columns if c != term]
    root = roots.select(F.col("term").alias("form"), F.lit(True).alias("is_root"))
    best = F.min(F.when(F.col("is_root"), F.col("at")))
    forms = words.select("*", F.explode_outer(candidates(term)).alias("c")).select(
        term, *others, F.col("c.form").alias("form"), _order(F.col(term), F.col("c")).alias("at")
    )
    if roots_fit:
        known = forms.join(F.broadcast(root), "form", "left")
    else:
        forms = materialized(forms)
        uses = forms.groupBy("form").agg(F.count("*").alias("uses"))
        table = materialized(uses.join(root.distinct(), "form", "left"))
        known = join_by_term(forms, table, ["form"], broadcast=False, limit=hot)
    return (
        known.groupBy(term)
        .agg(best.alias("best"), *[F.first(c).alias(c) for c in others])
        .select(term, *others, F.coalesce(F.col("best.form"), F.col(term)).alias(stem))
    )
