"""Token arrays: splitting, word-list filters and the noise filter."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Header words dropped by the headed thesis profile.
HEADER_WORDS = ("abstrak", "judul", "latar", "belakang")

# English words and shortest length the full-text analyser leaves out.
ENGLISH_STOP_WORDS = (
    "a an and are as at be by can for from have if in is it may not of on or tbd that the "
    "this to us we when will with yet you your"
).split()
MIN_INDEXED_LENGTH = 2

# What makes a token noise.
MIN_TOKEN_LENGTH = 3
VOWEL = "[aeiou]"
TRIPLED = r"(.)\1{2,}"
DIGITS = r"^\d+$"


def split_words(normalized: Column) -> Column:
    """Words of a normalised text; an empty text has none."""
    return F.array_remove(F.split(normalized, " "), "")


def join_words(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def is_noise(token: Column, min_len: int = MIN_TOKEN_LENGTH) -> Column:
    """Too short, without a vowel, one character three times in a row, or digits only."""
    return (
        (F.length(token) < min_len)
        | ~token.rlike(VOWEL)
        | token.rlike(TRIPLED)
        | token.rlike(DIGITS)
    )


def drop_noise(tokens: Column, min_len: int = MIN_TOKEN_LENGTH) -> Column:
    return F.filter(tokens, lambda t: ~is_noise(t, min_len))


def drop_words(tokens: Column, words: Iterable[str]) -> Column:
    """Remove a short word list, order and repeats of the rest kept."""
    listed = sorted(set(words))
    return F.filter(tokens, lambda t: ~t.isin(listed)) if listed else tokens


def drop_short(tokens: Column, min_len: int = MIN_INDEXED_LENGTH) -> Column:
    return F.filter(tokens, lambda t: F.length(t) >= min_len)


def indexed_words(tokens: Column) -> Column:
    """Tokens the full-text analyser keeps; positions count over these only. Tokens of a
    clean corpus are in lower case already."""
    listed = sorted(ENGLISH_STOP_WORDS)
    return F.filter(tokens, lambda t: (F.length(t) >= MIN_INDEXED_LENGTH) & ~t.isin(listed))
