"""Mixing sources by temperature.

A source with token share p gets a weight proportional to p ** a. The exponent a, between 0
(all alike) and 1 (as they are), is the smallest at which no source is repeated more than a limit
allows, or the one at which the weights have a wanted entropy; both are monotone in a, so it is
found by bisection (sixteen exponents a pass, over the table of sources).

The weights are realised as budgets of tokens. A source's documents are dealt into blocks by
hash. An epoch takes the blocks in a random order of its own; a source takes whole epochs and,
of its last, the first blocks up to its budget. As this order is by hash, "the first blocks"
is one number a source: no document is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termshard.llm.common import materialized, whole, whole_row
from termshard.operators.bounds import broadcast_if_small

GRID, PASSES = 16, 8
BLOCK_TOKENS, MAX_BLOCKS = 1 << 14, 1 << 14


def token_count(text: Column) -> Column:
    """Blank-separated words and an end token: an estimate that needs no tokenizer."""
    return F.size(F.array_remove(F.split(text, r"[ \t-\r]+"), "")).cast("bigint") + 1


def _label(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def _measure(totals: DataFrame, exponents: list[float], budget: float | None, entropy: bool) -> list[float]:
    """For each exponent the entropy of the weights (nats), or the most repetitions of a source
    under the budget; without one, under the least budget that takes every source once."""
    log = F.log(F.col("tokens").cast("double"))
    peak = totals.agg(F.max(log).alias("top"), F.min(log).alias("low")).first()
    power = [F.sum(F.exp((log - peak["top"]) * a)).alias(f"z{i}") for i, a in enumerate(exponents)]
    first = [F.sum((log - peak["top"]) * a * F.exp((log - peak["top"]) * a)).alias(f"x{i}") for i, a in enumerate(exponents)]
    row = totals.agg(*power, *first).first()
    import math

    out = []
    for i, a in enumerate(exponents):
        z = row[f"z{i}"]
        if entropy:
            out.append(math.log(z) - row[f"x{i}"] / z)
        elif budget is None:
            out.append(math.exp((1 - a) * (peak["top"] - peak["low"])))
        else:
            share = math.exp(a * (peak["low"] - peak["top"])) / z
            out.append(budget * share / math.exp(peak["low"]))
    return out


def exponent(
    totals: DataFrame, repetitions: float | None = None, entropy: float | None = None, budget: float | None = None
) -> float:
    """The exponent for a limit of repetitions or for an entropy. A limit that even unchanged
    shares break gives 1; an entropy out of reach gives the nearer end."""
    if (repetitions is None) == (entropy is None):
        raise ValueError("give repetitions or entropy")
    lo, hi = 0.0, 1.0
    wanted = entropy if entropy is not None else repetitions

    def enough(v: float) -> bool:  # both fall as the exponent grows
        return v <= wanted

    for _ in range(PASSES):
        grid = [lo + (hi - lo) * i / GRID for i in range(GRID + 1)]
        values = _measure(totals, grid, budget, entropy is not None)
        at = next((i for i, v in enumerate(values) if enough(v)), GRID)
        if at == 0:
            return lo
        lo, hi = grid[at - 1], grid[at]
    return hi


def source_plan(
    docs: DataFrame, repetitions: float | None, entropy: float | None = None,
    budget: float | None = None, seed: int = 0,
) -> DataFrame:
    """One row per source: label, tokens, weight, budget, blocks, whole epochs and the hash up
    to which blocks of the last epoch are taken. ``docs``: _label, _id, _tokens."""
    totals = docs.groupBy("_label").agg(F.sum("_tokens").alias("tokens"))
    totals = materialized(totals)
    if totals.isEmpty():
        a = 1.0
    else:
        a = exponent(totals, repetitions, entropy, budget)
    top = totals.agg(F.max("tokens")).first()[0] or 1
    power = F.exp(F.log(F.col("tokens") / top) * a)
    norm = totals.agg(F.sum(power)).first()[0] or 1.0
    weight = power / norm
    # Without a budget: the least that takes every source at least once.
    least = totals.agg(F.max(F.col("tokens") / weight)).first()[0] or 0.0
    plan = totals.withColumns({"weight": weight, "_budget": weight * F.lit(float(budget or least))})
    ratio = F.col("_budget") / F.col("tokens")
    plan = plan.withColumns(
        {
            "_blocks": F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("int"),
            "_epochs": F.floor(ratio + 1e-9).cast("int"),
        }
    )
    plan = materialized(plan)
    blocked = with_plan(docs, plan, seed).groupBy("_label", "_block").agg(
        F.sum("_tokens").alias("_in"), F.first("_order").alias("_order"),
        F.first(F.col("_budget") - F.col("_epochs") * F.col("tokens")).alias("_rest"),
    )
    turn = Window.partitionBy("_label").orderBy("_order", "_block")  # at most MAX_BLOCKS rows
    taken = blocked.withColumn("_before", F.sum("_in").over(turn) - F.col("_in")).filter(
        F.col("_before") + F.col("_in") / 2 <= F.col("_rest")
    )
    last = taken.groupBy("_label").agg(F.max("_order").alias("_last"))
    return materialized(plan.join(last, "_label", "left"))


def with_plan(docs: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``docs`` with their source's plan, their block and its place in the last epoch."""
    joined = docs.join(broadcast_if_small(plan), "_label")
    joined = joined.withColumn("_block", F.pmod(F.xxhash64("_id", F.lit(seed)), F.col("_blocks")).cast("int"))
    return joined.withColumn("_order", F.xxhash64(F.lit(seed), "_label", "_epochs", "_block"))


def mixed(
    docs: DataFrame, repetitions: float | None = 1.5, entropy: float | None = None,
    budget: float | None = None, seed: int = 0, source: str = "source", text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """One row per document and epoch that takes it: ``_row`` (the whole row), ``weight``,
    ``epoch`` (from 0), ``block`` and ``block_order`` (its place in the epoch, any number).

    Without a budget every document is taken at least once. A null source is a source of its
    own; null texts weigh one token; rows with null or repeated keys are taken as any
    others, those of one key together. No rows give no rows.
    """
    rows = docs.select(
        whole_row(docs), _label(F.col(source)).alias("_label"),
        F.col(key).alias("_id"), F.col(text).alias("_text"),
    )
    light = materialized(rows.select("_label", "_id", token_count(whole("_text")).alias("_tokens")))
    plan = source_plan(light, repetitions, entropy, budget, seed)
    taken = with_plan(rows.drop("_text"), plan, seed)
    extra = F.coalesce((F.col("_order") <= F.col("_last")).cast("int"), F.lit(0))
    copies = (F.col("_epochs") + extra).alias("_n")
    spread = taken.select("*", copies).filter("_n > 0").select("*", F.explode(F.expr("sequence(0, _n - 1)")).alias("epoch"))
    return spread.select(
        "_row", "weight", "epoch", F.col("_block").alias("block"),
        F.xxhash64(F.lit(seed), "_label", "epoch", "_block").alias("block_order"),
    )


def mixed_documents(docs: DataFrame, repetitions: float = 1.5, seed: int = 0) -> DataFrame:
    """The documents, all columns, each as often as its source's budget takes it; null sources and
    texts, empty texts and repeated rows as in ``mixed``. No rows give no rows."""
    return mixed(docs, repetitions, seed=seed).select("_row.*")
