"""Raw corpora: the registry of themes, the text column, document numbers, the load report."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from termshard.sources import literals, records

# Names a text column may have, best first.
TEXT_COLUMNS = ("content", "text", "isi", "artikel", "judul", "title", "body", "description")


def pick_text_column(
    schema: T.StructType, forced: str | None = None, first_if_none: bool = False
) -> str:
    """The column to analyse: the forced one if it exists, a known name in any case, or the
    first string column. Without any, the first column if ``first_if_none``, else an error."""
    names = schema.fieldNames()
    if forced and forced in names:
        return forced
    by_lower = {name.lower(): name for name in names}
    known = [by_lower[k] for k in TEXT_COLUMNS if k in by_lower]
    strings = [f.name for f in schema if isinstance(f.dataType, T.StringType)]
    fallback = names[:1] if first_if_none else []
    for name in known + strings + fallback:
        return name
    raise ValueError(f"no text column among {names}")


def read_csv_corpus(
    spark: SparkSession,
    path,
    theme: str,
    text_col: str | None = None,
    id_col: str | None = None,
    repair: bool = False,
    first_if_none: bool = False,
) -> DataFrame:
    """``(theme, doc_id, text)`` of one CSV corpus, numbered by position unless it has a key: over all
    files, in the order of their names."""
    rows = records.read_rows(spark, path, repair)
    text = pick_text_column(rows.schema[records.DATA].dataType, text_col, first_if_none)
    fields = [F.col(records.DATA)[text].alias("text")]
    if id_col:
        key = F.col(records.DATA)[id_col].cast("bigint").alias("doc_id")
        return rows.select(F.lit(theme).alias("theme"), key, *fields)
    return rows.select(F.lit(theme).alias("theme"), F.col(records.POSITION).alias("doc_id"), *fields)


def as_documents(
    df: DataFrame,
    theme_col: str,
    id_col: str,
    text_col: str | None = None,
    first_if_none: bool = False,
) -> DataFrame:
    """``(theme, doc_id, text)`` of a table that has a key."""
    text = pick_text_column(df.schema, text_col, first_if_none)
    return df.select(
        F.col(theme_col).alias("theme"),
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text).alias("text"),
    )


@dataclass(frozen=True)
class Theme:
    """One registered corpus. ``format`` is ``tokens`` (Parquet) or ``literal`` (CSV)."""

    name: str
    path: str
    format: str = "tokens"


@dataclass
class Loaded:
    """Token tables of the corpora that could be read, and what happened to each."""

    tokens: DataFrame | None
    report: DataFrame
    themes: DataFrame
    errors: dict[str, str] = field(default_factory=dict)


REPORT_SCHEMA = "theme string, ordinal int, loaded boolean, error string"


def themes_table(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """The registry: themes with their order, which breaks ties between equal scores."""
    return spark.createDataFrame(
        [(name, i) for i, name in enumerate(names)], "theme string, ordinal int"
    )


def _open(spark: SparkSession, theme: Theme) -> DataFrame:
    if theme.format == "literal":
        tokens = literals.read_clean_csv(spark, theme.path, theme.name)
    elif theme.format == "tokens":
        stored = spark.read.parquet(theme.path)
        literals.require_column(stored, "tokens")
        tokens = stored.select(F.lit(theme.name).alias("theme"), "doc_id", "tokens")
    else:
        raise ValueError(f"unknown corpus format {theme.format!r}")
    return tokens


def load_corpora(
    spark: SparkSession,
    themes: Iterable[Theme],
    searchable: Iterable[str] | None = None,
    index=None,
) -> Loaded:
    """Open and count every corpus; one that fails is reported and the rest go on.

    A theme is searchable if the stored ``index`` (of counts or of text) has a word of it, or if
    ``searchable`` names it; a loaded theme that is not counts in the statistics all the
    same. The report has ``theme, ordinal, loaded,
    searchable, n_docs, error``.
    """
    themes = list(themes)
    opened: list[DataFrame] = []
    errors: dict[str, str] = {}
    sizes: list[tuple[str, int]] = []
    for theme in themes:
        try:
            corpus = _open(spark, theme)
            sizes.append((theme.name, corpus.count()))
            opened.append(corpus)
        except Exception as error:  # any fault of one corpus must not stop the others
            known = isinstance(error, (AnalysisException, ValueError))
            errors[theme.name] = str(error).splitlines()[0] if known else type(error).__name__
    tokens = None
    for corpus in opened:
        tokens = corpus if tokens is None else tokens.unionByName(corpus)
    status = spark.createDataFrame(
        [(t.name, i, t.name not in errors, errors.get(t.name)) for i, t in enumerate(themes)],
        REPORT_SCHEMA,
    )
    counts = spark.createDataFrame(sizes, "theme string, n_docs bigint")
    if index is not None:
        found = index.vocabulary.select("theme").distinct().collect()  # one row per corpus
        indexed = [r["theme"] for r in found]
    else:
        indexed = [t.name for t in themes] if searchable is None else list(searchable)
    n_docs = F.coalesce("n_docs", F.lit(0))
    report = status.join(counts, "theme", "left").select(
        "theme",
        "ordinal",
        "loaded",
        (F.col("loaded") & F.col("theme").isin(indexed)).alias("searchable"),
        n_docs.alias("n_docs"),
        "error",
    )
    loaded_names = [t.name for t in themes if t.name not in errors]
    return Loaded(tokens, report, themes_table(spark, [t.name for t in themes]).filter(
        F.col("theme").isin(loaded_names)), errors)
