"""Text normal forms as Column builders.

Every form folds case, blanks out links and mentions, and keeps the letters a-z only, one
blank between words. The forms differ in what happens before the links are removed.

Java's ``\\s`` and ``\\w`` are ASCII unless ``(?U)`` is set, and even then leave out the
separators U+001C to U+001F, so the classes below name them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define the normal forms.
URL = r"(?U)(?:https?://|www\.)[^\s\x1c-\x1f]+"
MENTION = r"@[\p{L}\p{N}_]+"
NOT_LETTERS = r"[^a-z]+"
NOT_LETTERS_OR_SPACE = r"(?U)[^a-z\s\x1c-\x1f]"
SPACES = r"(?U)[\s\x1c-\x1f]+"
REDUPLICATED = r"(?U)\b([a-z]+)-\1\b"
GLUED_HEADER = r"(?U)(ABSTRAK|Judul|Latar[\s\x1c-\x1f]*Belakang)(?=[A-Z])"
QUOTES_AND_BREAKS = "\"\u201c\u201d\u00a0\n"


def text_or_empty(col: Column) -> Column:
    """The cell as text; a missing cell is an empty text."""
    return F.coalesce(col.cast("string"), F.lit(""))


def blank_links(col: Column) -> Column:
    return F.regexp_replace(col, URL, " ")


def blank_mentions(col: Column) -> Column:
    return F.regexp_replace(col, MENTION, " ")


def blank_quotes(col: Column) -> Column:
    """Double quotes, no-break spaces and newlines become blanks, so a quote ends a link."""
    return F.translate(col, QUOTES_AND_BREAKS, " " * len(QUOTES_AND_BREAKS))


def blank_reduplicated(col: Column) -> Column:
    """``jalan-jalan`` disappears whole; ``kejar-kejaran`` stays."""
    return F.when(col.contains("-"), F.regexp_replace(col, REDUPLICATED, " ")).otherwise(col)


def unglue_headers(col: Column) -> Column:
    """Set a blank after a header that is glued to the next capital. Runs before case folding."""
    text = text_or_empty(col)
    may_hold = text.contains("ABSTRAK") | text.contains("Judul") | text.contains("Latar")
    return F.when(may_hold, F.regexp_replace(text, GLUED_HEADER, "$1 ")).otherwise(text)


def letters_only(col: Column) -> Column:
    """Runs of anything but a-z become one blank; covers hash signs, digits and whitespace."""
    return F.trim(F.regexp_replace(col, NOT_LETTERS, " "))


def _words(lowered: Column, quotes_end_links: bool = False) -> Column:
    """Links and mentions are rare: a plain substring test saves most texts the two patterns.

    A link that holds the only at-sign costs one needless pass and changes nothing. Quotes are
    no letters and go in any case; blanking them first matters to a text with links only.
    """
    may_link = lowered.contains("http") | lowered.contains("www.")
    before_links = blank_quotes(lowered) if quotes_end_links else lowered
    linkless = F.when(may_link, blank_links(before_links)).otherwise(lowered)
    return letters_only(
        F.when(lowered.contains("@"), blank_mentions(linkless)).otherwise(linkless)
    )


def plain(col: Column) -> Column:
    return _words(F.lower(text_or_empty(col)))


def quoted(col: Column) -> Column:
    return _words(F.lower(text_or_empty(col)), quotes_end_links=True)


def headed(col: Column) -> Column:
    return quoted(unglue_headers(col))


def reduplicated(col: Column) -> Column:
    return _words(blank_reduplicated(F.lower(text_or_empty(col))))


def query_letters(col: Column) -> Column:
    """Query form before its stop words go: characters outside a-z are deleted, not blanked."""
    return F.regexp_replace(F.lower(text_or_empty(col)), NOT_LETTERS_OR_SPACE, "")


def squeeze(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, SPACES, " "))


def query(col: Column) -> Column:
    return squeeze(query_letters(col))


FORMS: dict[str, Callable[[Column], Column]] = {
    "plain": plain,
    "quoted": quoted,
    "headed": headed,
    "reduplicated": reduplicated,
    "query": query,
}


def normalize(col: Column, form: str = "plain") -> Column:
    if form not in FORMS:
        raise ValueError(f"unknown normal form {form!r}; known: {sorted(FORMS)}")
    return FORMS[form](col)
