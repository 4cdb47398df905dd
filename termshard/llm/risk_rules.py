"""Quality rules whose cutoffs are chosen on labelled documents under a guarantee.

Each rule is a share (of symbols, of repeated lines, ...). The cutoffs form one sequence from lenient
to strict: at each a document fails if any of its shares reaches the cutoff, so what fails at one
fails at all that follow. A cutoff may be used only if, on the labelled good documents of the
stratum, the exact binomial test rejects a false rejection rate above ``risk`` (the upper
Clopper-Pearson bound is below it). Cutoffs are tested in order until one fails, which needs no
correction among them; strata are corrected for by dividing ``error`` by their number. So with
probability ``1 - error`` no stratum loses more than ``risk`` of its good documents. Of the
cutoffs allowed, the one that best separates labelled bad from good documents is used, and none
where none rejects a bad one. Strata with too few good labels for a test of their own are tested
together, as one stratum.

All of it is DataFrame functions: documents are measured in one pass without a shuffle, and of
the labelled ones only counts by stratum, rule and cutoff are gathered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termshard.llm.common import materialized, whole, whole_row
from termshard.operators.bounds import broadcast_if_small

BLANK = r"[ \t-\r]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
RULES = ("symbols", "dup_lines", "repeats", "shouts", "capitals")
CUTOFFS = (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05, 0.02)
GOOD_WEIGHT = 5


def _repeated(windows: str, width: int) -> Column:
    """Words in windows that occur again, from the array of window hashes: equal hashes are
    neighbours once sorted; then positions that overlap count once."""
    m = f"size({windows})"
    sorted_ = f"sort_array(arrays_zip({windows}, sequence(0, {m} - 1)))"
    pairs = f"arrays_zip(slice({sorted_}, 1, {m} - 1), slice({sorted_}, 2, {m} - 1))"
    equal = f"filter({pairs}, p -> p.`0`.`{windows}` = p.`1`.`{windows}`)"
    places = F.expr(f"array_distinct(flatten(transform({equal}, p -> array(p.`0`.`1`, p.`1`.`1`))))")
    return F.when(F.expr(f"size(array_distinct({windows})) < {m}"), F.sort_array(places)).alias("_places")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as a struct ``_row`` with the counts and the rule shares of each text."""
    body = whole(F.col("_row")[text])
    rows = docs.select(whole_row(docs))
    step = rows.withColumn("_words", F.array_remove(F.split(body, BLANK), ""))
    step = step.withColumn("n_words", F.size("_words").cast("bigint"))
    runs = [f"slice(_words, {i + 1}, greatest(int(n_words) - {WINDOW - 1}, 0))" for i in range(WINDOW)]
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    step = step.select(
        "_row", "n_words",
        F.char_length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count(body, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.regexp_count(body, F.lit("!")).cast("bigint").alias("_shouts"),
        F.regexp_count(body, F.lit("[A-Z]")).cast("bigint").alias("_capitals"),
        lines.alias("_lines"),
        F.expr(f"transform(arrays_zip({', '.join(runs)}), w -> xxhash64(w))").alias("_windows"),
    )
    step = step.select(
        "_row", "n_words", "word_chars", "n_symbols", "_shouts", "_capitals",
        F.size("_lines").cast("bigint").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        _repeated("_windows", WINDOW),
    )
    gaps = "zip_with(slice(_places, 1, size(_places) - 1), slice(_places, 2, size(_places) - 1), "
    covered = f"aggregate({gaps}(a, b) -> least({WINDOW}, b - a)), {WINDOW}, (s, g) -> s + int(g))"
    step = step.withColumn(
        "n_repeat_words",
        F.when(F.col("_places").isNull(), 0).otherwise(F.expr(covered)).cast("bigint"),
    )

    def share(part: str, of: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part), F.col(of)), F.lit(0.0))

    return step.withColumns(
        {
            "_symbols": share("n_symbols", "n_words"),
            "_dup_lines": share("n_dup_lines", "_n_lines"),
            "_repeats": share("n_repeat_words", "n_words"),
            "_shouts": share("_shouts", "n_words"),
            "_capitals": share("_capitals", "word_chars"),
            "base_failed": F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"),
        }
    ).drop("_places", "_n_lines")


def binomial_cdf(k: str, n: str, p: float) -> Column:
    """P(X <= k) of Binomial(n, p), exactly: the terms summed from 0 in logarithms."""
    odds, none = math.log(p / (1 - p)), f"({n} * {math.log1p(-p)!r}D)"
    term = f"s.t + ln(double({n} - i + 1)) - ln(double(i)) + {odds!r}D"
    total = f"greatest(s.l, {term}) + ln(1 + exp(-abs(s.l - ({term}))))"
    steps = f"if({k} > 0, sequence(1L, {k}), array())"
    start = f"named_struct('t', {none}, 'l', {none})"
    return F.expr(f"exp(aggregate({steps}, {start}, (s, i) -> named_struct('t', {term}, 'l', {total}), s -> s.l))")


def calibrated(shares: DataFrame, labels: DataFrame, risk: float, error: float) -> DataFrame:
    """One row per stratum with a usable cutoff: ``_stratum`` and ``_cutoff``.

    ``shares``: doc_id, stratum and rule shares. ``labels``: doc_id and quality; a document
    with several labels is good if all are 1; null labels don't count. Strata without labels have
    no cutoff.
    """
    outcome = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("_good"))
    worst = F.greatest(*(F.col(f"_{r}") for r in RULES)).alias("_share")
    known = shares.select("_id", "_stratum", worst).join(outcome.withColumnRenamed("doc_id", "_id"), "_id")

    def number(good: int, least: float = 0.0) -> Column:
        return F.sum(F.when((F.col("_good") == good) & (F.col("_share") >= least), 1).otherwise(0))

    names = [f"{n}{i}" for i in range(len(CUTOFFS)) for n in "kb"]
    over = [number(g, c).alias(f"{n}{i}") for i, c in enumerate(CUTOFFS) for g, n in ((1, "k"), (0, "b"))]
    counts = materialized(known.groupBy("_stratum").agg(number(1).alias("n"), number(0).alias("m"), *over))
    # As many good labels as a test without a rejected one needs, if each stratum is tested.
    fewest = math.log(max(1, counts.count()) / error) / -math.log1p(-risk)
    counts = counts.withColumn("_own", F.col("n") >= fewest)
    group = F.when(F.col("_own"), F.struct(F.col("_stratum").alias("s"), F.lit(1).alias("own")))
    counts = counts.withColumn("_group", group)  # null: those tested together
    tested = materialized(counts.groupBy("_group").agg(*(F.sum(c).alias(c) for c in ("n", "m", *names))))
    tests = max(1, tested.count())
    grid = F.array(*(F.struct(F.lit(c).alias("cutoff"), F.col(f"k{i}").alias("k"), F.col(f"b{i}").alias("b")) for i, c in enumerate(CUTOFFS)))
    each = tested.select("_group", "n", "m", F.inline(grid))
    # A count at or above the limit can't pass: the sum need not be made.
    sure = F.when(F.col("k") < F.col("n") * risk, binomial_cdf("k", "n", risk)).otherwise(1.0)
    lenient_first = Window.partitionBy("_group").orderBy(F.desc("cutoff"))
    each = each.withColumn("_worst", F.max(sure).over(lenient_first)).filter(
        (F.col("_worst") <= error / tests) & (F.col("b") > 0)
    )
    gain = F.col("b") / F.col("m") - GOOD_WEIGHT * F.col("k") / F.col("n")
    best = each.groupBy("_group").agg(F.max(F.struct(gain.alias("gain"), "cutoff")).alias("best"))
    chosen = best.select(F.col("_group").alias("_g"), F.col("best.cutoff").alias("_cutoff"))
    return counts.join(chosen, F.col("_group").eqNullSafe(F.col("_g"))).select("_stratum", "_cutoff")


def _judged(rows: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``rows`` with ``kept``. Cutoffs are broadcast if their measured size allows."""
    cut = broadcast_if_small(materialized(cutoffs.withColumnRenamed("_stratum", "_s")))
    worst = F.greatest(*(F.col(f"_{r}") for r in RULES))
    failed = F.col("base_failed") | F.coalesce(worst >= F.col("_cutoff"), F.lit(False))
    return rows.join(cut, F.col("_stratum").eqNullSafe(F.col("_s")), "left").withColumn("kept", ~failed)


def quality_report(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
    stratum: str = "lang", risk: float = 0.05, error: float = 0.05,
) -> DataFrame:
    """Per row the counts, ``base_failed`` and ``kept``.

    A null or empty text has no words and fails; a null stratum is one of its own; a row without
    a key can't be labelled but is judged. Repeated rows are judged alike, and repeated keys
    count as often as they occur. No labels, or too few even together, leave the base rule alone to
    reject, as does a stratum without any.
    """
    shares = [f"_{r}" for r in RULES]
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = measured(docs, text).select(
        F.col("_row")[key].alias("_id"), F.col("_row")[stratum].alias("_stratum"), *counts, *shares
    )
    rows = materialized(rows)
    judged = _judged(rows, calibrated(rows, labels, risk, error))
    return judged.select(F.col("_id").alias(key), *counts, "kept")


def keep_quality(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
    stratum: str = "lang", risk: float = 0.05, error: float = 0.05,
) -> DataFrame:
    """The rows of ``docs``, all columns, that ``quality_report`` keeps; nulls, empty texts and
    repeated rows are judged as there, and no rows give none. The measured rows are stored once, so
    that neither the cutoffs nor the filter measures a text again."""
    rows = measured(docs, text).withColumns({"_id": F.col("_row")[key], "_stratum": F.col("_row")[stratum]})
    shares = [f"_{r}" for r in RULES]
    rows = materialized(rows.select("_row", "_id", "_stratum", "base_failed", *shares))
    cutoffs = calibrated(rows.drop("_row"), labels, risk, error)
    return _judged(rows, cutoffs).filter("kept").select("_row.*")
