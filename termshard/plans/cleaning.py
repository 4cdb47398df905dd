"""The job that turns a raw corpus into a clean one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from termshard.operators.bounds import scratch_space
from termshard.plans.profiles import Profile, StopWords, analyse
from termshard.sources.corpora import read_csv_corpus


@dataclass(frozen=True)
class CleaningReport:
    theme: str
    rows_read: int
    rows_written: int


def write_tokens(tokens: DataFrame, path: str, mode: str = "errorifexists") -> None:
    tokens.write.mode(mode).partitionBy("theme").parquet(path)


def clean_corpus(
    spark: SparkSession,
    source: str,
    target: str,
    theme: str,
    profile: Profile,
    stop: StopWords,
    roots: DataFrame,
    text_col: str | None = None,
    id_col: str | None = None,
    repair: bool = False,
) -> CleaningReport:
    """Read a CSV corpus, analyse it, write ``(theme, doc_id, tokens)``.

    The CSV is parsed once, into the stored words, which are removed in the end. Both counts come
    from the jobs themselves.
    """
    read, written = Observation(), Observation()
    with scratch_space(spark):
        raw = read_csv_corpus(
            spark, source, theme, text_col, id_col, repair, first_if_none=profile.name == "news"
        )
        counted = raw.observe(read, F.count(F.lit(1)).alias("rows"))
        tokens = analyse(counted, profile, stop, roots)
        write_tokens(tokens.observe(written, F.count(F.lit(1)).alias("rows")), target)
    return CleaningReport(theme, read.get["rows"], written.get["rows"])
