"""Columns for a result listing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREVIEW_CHARS = 200
SCORE_DIGITS = 4


def preview(content: Column, chars: int = PREVIEW_CHARS) -> Column:
    """The first characters of the content, tokens joined by blanks."""
    return F.substring(F.array_join(content, " "), 1, chars)


def shown_score(score: Column, digits: int = SCORE_DIGITS) -> Column:
    return F.round(score, digits)


def document_key(theme: Column, doc_id: Column) -> Column:
    return F.concat_ws("_", theme, doc_id.cast("string"))
