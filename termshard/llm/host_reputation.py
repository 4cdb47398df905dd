"""URL filtering by rules and by the reputation of hosts.

Labelled page outcomes are shrunk from level to level: a suffix towards all pages, a registered
domain towards its suffix, a host towards its domain. At each level the groups share one
beta-binomial prior strength, found from how much more their rates vary than chance allows
(moments). A host without labels has its domain's prior, a domain without any its suffix's.
A host is blocked if the beta posterior gives a good rate of at least ``min_good`` a probability
below ``chance``: sparse hosts are blocked only where their prior supports it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termshard.llm.common import ascii_lower, materialized, whole
from termshard.operators.bounds import broadcast_if_small

WEAKEST, STRONGEST = 1.0, 1000.0


def host_of(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(whole(url), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: str | Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(whole(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def domain_of(host: Column, suffixes: tuple[str, ...] = ()) -> tuple[Column, Column]:
    """Registered domain and suffix: the last label or the longest of ``suffixes`` that ends the
    host, and one label more. A host with no more labels is its own domain."""
    suffix = F.substring_index(host, ".", -1)
    labels = F.lit(2)
    for known in sorted(suffixes, key=len):
        ends = (host == known) | host.endswith(f".{known}")
        suffix = F.when(ends, F.lit(known)).otherwise(suffix)
        labels = F.when(ends, F.lit(known.count(".") + 2)).otherwise(labels)
    parts = F.split(host, r"\.")
    count = F.least(F.size(parts), labels)
    return F.array_join(F.slice(parts, -count, count), "."), suffix


def prior_strength(groups: DataFrame) -> float:
    """Prior strength of groups (n, k, m: labels, good ones, expected rate), by moments."""
    chance = F.col("m") * (1 - F.col("m"))
    off = F.col("n") * F.pow(F.col("k") / F.col("n") - F.col("m"), 2)
    row = groups.filter((F.col("n") > 0) & (chance > 0)).agg(
        F.sum(off / chance), F.count("*"), F.sum(F.col("n").cast("double"))
    ).first()
    # n (k/n - m)^2 / (m (1 - m)) is expected to be 1 + (n - 1) / (strength + 1).
    spread, count, total = row
    if not count or total <= count:
        return STRONGEST
    excess = (spread - count) / (total - count)
    if excess <= 0:
        return STRONGEST
    return min(STRONGEST, max(WEAKEST, (1 - excess) / excess))


def _log_gamma(z: str) -> str:
    """For z > 0: Stirling's series at z + 8, less the logarithm of the factors in between."""
    w = f"({z} + 8D)"
    series = f"1D / (12D * {w}) - 1D / (360D * pow({w}, 3)) + 1D / (1260D * pow({w}, 5)) - 1D / (1680D * pow({w}, 7))"
    between = " * ".join(f"({z} + {i}D)" for i in range(8))
    return f"(({w} - 0.5D) * ln({w}) - {w} + {math.log(2 * math.pi) / 2!r}D + {series} - ln({between}))"


def _fraction(a: str, b: str, x: str) -> str:
    """The continued fraction of the incomplete beta function from its front, two coefficients a
    round; the rounds needed grow with the square root of a and b."""
    rounds = f"sequence(1L, 80L + bigint(4 * sqrt({a} + {b})))"
    even = f"i * ({b} - i) * {x} / (({a} + 2 * i - 1) * ({a} + 2 * i))"
    odd = f"-({a} + i) * ({a} + {b} + i) * {x} / (({a} + 2 * i) * ({a} + 2 * i + 1))"

    def state(c: str, d: str, h: str) -> str:
        return f"named_struct('c', {c}, 'd', {d}, 'h', {h})"

    step = "s"
    for coefficient in (even, odd):
        c, d = f"(1D + ({coefficient}) / {step}.c)", f"(1D / (1D + ({coefficient}) * {step}.d))"
        step = state(c, d, f"{step}.h * {c} * {d}")
    d = f"(1D / (1D - ({a} + {b}) * {x} / ({a} + 1)))"
    return f"aggregate({rounds}, {state('1D', d, d)}, (s, i) -> {step}, s -> s.h)"


def beta_tail(a: str, b: str, x: float) -> Column:
    """P(X >= x) of Beta(a, b) for the columns ``a`` and ``b``, both positive, and x within 0 and 1."""
    if not 0 < x < 1:
        return F.lit(1.0 if x <= 0 else 0.0)
    low, high = f"{x!r}D", f"{1 - x!r}D"
    front = f"exp({_log_gamma(f'({a} + {b})')} - {_log_gamma(a)} - {_log_gamma(b)} + {a} * ln({low}) + {b} * ln({high}))"
    below = f"1D - {front} * {_fraction(a, b, low)} / {a}"
    above = f"{front} * {_fraction(b, a, high)} / {b}"
    return F.expr(f"CASE WHEN {low} < ({a} + 1) / ({a} + {b} + 2) THEN {below} ELSE {above} END")


def reputations(
    pages: DataFrame, outcomes: DataFrame, url: str = "url", min_good: float = 0.5,
    suffixes: tuple[str, ...] = (),
) -> DataFrame:
    """One row per host of ``pages``: ``host``, ``labelled``, ``good_rate``, the posterior's mean, and
    ``p_good``, the probability that the rate is at least ``min_good``.

    ``outcomes``: url and ``good``, 1 or 0; null outcomes don't count. Without outcomes every
    rate is 0.5. Hosts that only outcomes have count for their levels. Prior strengths are kept
    within WEAKEST and STRONGEST.
    """
    domain, suffix = domain_of(F.col("host"), suffixes)
    known = outcomes.filter(F.col("good").isNotNull()).groupBy(host_of(url).alias("host")).agg(
        F.count("*").alias("n"), F.sum("good").alias("k")
    )
    named = pages.select(host_of(url).alias("host")).distinct()
    hosts = named.join(known, "host", "full").select(
        "host", domain.alias("domain"), suffix.alias("suffix"),
        F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("k", F.lit(0)).alias("k"),
    )
    hosts = materialized(hosts)
    counts = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    total = hosts.agg(*counts).first()
    above = (total["k"] + 0.5) / (total["n"] + 1) if total["n"] else 0.5

    def posterior(groups: DataFrame, name: str) -> DataFrame:
        s = prior_strength(groups)
        return groups.withColumn(name, (F.col("k") + F.col("m") * s) / (F.col("n") + s)).withColumn(
            "strength", F.col("n") + s
        )

    level = hosts.groupBy("suffix").agg(*counts).withColumn("m", F.lit(above))
    level = posterior(materialized(level), "m_suffix").select("suffix", F.col("m_suffix").alias("m"))
    domains = hosts.groupBy("suffix", "domain").agg(*counts).join(level, "suffix")
    level = posterior(materialized(domains), "m_domain").select("domain", "suffix", F.col("m_domain").alias("m"))
    final = posterior(materialized(hosts.join(level, ["domain", "suffix"])), "good_rate")
    rate, size = F.col("good_rate"), F.col("strength")
    final = final.withColumns({"_a": rate * size, "_b": (1 - rate) * size})
    p_good = beta_tail("_a", "_b", min_good).alias("p_good")
    return final.select("host", F.col("n").alias("labelled"), "good_rate", p_good)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as struct (rule, verdict), or null. ``rules``: (rule, allow or
    block); a rule is a host, which covers its subdomains, and the start of a path."""
    found = F.lit(None)
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at = rule.index("/")
        name, start = rule[:at], rule[at:]
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def judged_pages(
    pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], min_good: float = 0.5,
    chance: float = 0.05, url: str = "url", key: str = "page_id",
) -> DataFrame:
    """Key, ``host``, ``path``, ``rule``, ``verdict``, ``good_rate``, ``p_good`` of every row.

    A null url or one without ``://`` has an empty host, which is judged as any other host.
    Repeated rows are judged one by one; other columns are ignored; no rows give no rows.
    """
    known = materialized(reputations(pages, outcomes, url, min_good)).withColumnRenamed("host", "_host")
    host, path = F.col("host"), F.col("path")
    rows = pages.select(F.col(key), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.join(broadcast_if_small(known), F.col("host") == F.col("_host"), "left")
    rows = rows.withColumn("_rule", matching_rule(host, path, rules))
    own = F.when(F.col("p_good") < chance, "block").otherwise("allow")
    return rows.select(
        key, "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), own).alias("verdict"), "good_rate", "p_good",
    )
