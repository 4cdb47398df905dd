"""The operators of this package as queries: ``(spark, folder of Parquet tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termshard.llm import content_sort, filter_audit, hard_negatives, host_reputation, language, minhash
from termshard.llm import mixing, packing, risk_rules, sentence_pieces, site_quality, token_files, tool_calls
from termshard.llm.common import scratch_path, table

Query = Callable[[SparkSession, str], DataFrame]


RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
SCHEMAS = [
    ("ask", "turn", "integer", True), ("ask", "text", "string", True),
    ("configure", "turn", "integer", True), ("configure", "text", "string", False),
]


def op1_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    calls, results = tool_calls.turns_as_calls(table(spark, folder, "conversations"))
    schemas = spark.createDataFrame(SCHEMAS, "name string, field string, type string, required boolean")
    rows = tool_calls.tool_records(calls, results, schemas)
    return rows.select(
        "conv_id", "call_id", "name", "turn", "position", "hops", "result_turn", "n_calls", "n_results",
        "valid", F.array_join("errors", ";").alias("errors"), "record",
    )


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Urls with the quality of the document whose number is in their path."""
    number = F.regexp_extract(host_reputation.path_of("url"), r"/(\d+)", 1)
    numbered = pages.select("url", number.try_cast("bigint").alias("doc_id"))
    return numbered.join(labels, "doc_id").select("url", F.col("quality").alias("good"))


def op2_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    outcomes = page_outcomes(pages, table(spark, folder, "labels"))
    judged = host_reputation.judged_pages(pages, outcomes, RULES)
    return judged.withColumns({c: F.round(c, 6) for c in ("good_rate", "p_good")})


def op3_temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    taken = mixing.mixed(table(spark, folder, "documents"))
    return taken.select("_row.doc_id", "_row.source", "weight", "epoch", "block", "block_order")


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op5_content_sort(spark: SparkSession, folder: str) -> DataFrame:
    return content_sort.content_groups(table(spark, folder, "documents"), keep="largest")


def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), width=3, percent=85)


def op7_range_coded_tokens(spark: SparkSession, folder: str) -> DataFrame:
    to = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, folder, "documents"), to)
    return token_files.read_tokens(spark, to)


def op8_site_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Good is of quality and not toxic. A document's site is that of the page that shows it."""
    labels = table(spark, folder, "labels")
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    outcomes = labels.select("doc_id", good.cast("int").alias("good"))
    path = host_reputation.path_of("url")
    sites = table(spark, folder, "pages").select(
        F.regexp_extract(path, r"/(\d+)", 1).try_cast("bigint").alias("doc_id"),
        host_reputation.host_of("url").alias("host"),
        F.regexp_extract(path, r"^/([^/]*)/", 1).alias("path"),
    )
    return site_quality.scored(table(spark, folder, "documents"), outcomes, sites)


def op9_risk_controlled_rules(spark: SparkSession, folder: str) -> DataFrame:
    return risk_rules.quality_report(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    learnt = docs.filter(~language.held_out() & F.col("doc_id").isNotNull())
    predicted = language.predict(docs, language.fit(learnt))
    return predicted.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op11_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    rows = sentence_pieces.decoded(sentence_pieces.encoded(table(spark, folder, "documents")))
    numbers = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(numbers, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Some labels are moved on by one, so that near vectors differ in label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.quantised(table(spark, folder, "embeddings").withColumn("label", moved))
    return hard_negatives.hard_negatives(rows, rows.filter(hard_negatives.anchors_of(100, "id")))


def llm_queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
