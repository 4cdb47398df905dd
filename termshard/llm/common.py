"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termshard.operators.bounds import materialized, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"

__all__ = ["BLANKS", "UPPER", "ascii_lower", "materialized", "partitions", "scratch_path", "whole", "whole_row"]


def whole(text: str | Column = "text") -> Column:
    """The text, null counting as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column, F.lit(""))


def whole_row(docs: DataFrame) -> Column:
    """All columns, whatever their names, as the struct ``_row``; ``_row.*`` gives them back."""
    return F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in docs.columns)).alias("_row")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` does just that where all characters are ASCII."""
    one_byte = F.octet_length(text) == F.char_length(text)
    return F.when(one_byte, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
