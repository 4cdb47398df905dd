"""Clean corpora as list-literal text, e.g. ``['machine', 'learn']``: import and export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termshard.sources.records import DATA, POSITION, read_rows, write_csv

# Fixed value: the one column of a clean corpus.
CLEAN_COLUMN = "clean_tokens"


def to_literal(tokens: Column) -> Column:
    quoted = F.transform(tokens, lambda t: F.concat(F.lit("'"), t, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def literal_text(literal: Column) -> Column:
    """Brackets off both ends, quotes deleted, commas to blanks."""
    bare = F.btrim(literal, F.lit("[]"))
    return F.translate(F.replace(bare, F.lit("'"), F.lit("")), ",", " ")


def from_literal(literal: Column) -> Column:
    return F.array_remove(F.split(literal_text(literal), r"\s+"), "")


def require_column(df: DataFrame, column: str = CLEAN_COLUMN) -> DataFrame:
    if column not in df.columns:
        raise ValueError(f"column {column!r} not found; the columns are {df.columns}")
    return df


def write_clean_csv(tokens: DataFrame, path: str) -> None:
    """One column, one row per document, in document order within each file."""
    ordered = tokens.repartitionByRange("theme", "doc_id").sortWithinPartitions("theme", "doc_id")
    write_csv(ordered.select(to_literal(F.col("tokens")).alias(CLEAN_COLUMN)), path)


def read_clean_csv(spark: SparkSession, path, theme: str) -> DataFrame:
    """``(theme, doc_id, tokens)``; the id is the 0-based position of the row in the corpus."""
    rows = read_rows(spark, path)
    require_column(rows.select(f"{DATA}.*"))
    return rows.select(
        F.lit(theme).alias("theme"),
        F.col(POSITION).alias("doc_id"),
        from_literal(F.col(DATA)[CLEAN_COLUMN]).alias("tokens"),
    )
