"""String expressions: whitespace, cleaning steps, character n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def collapse_whitespace(text: Column) -> Column:
    """Every run of whitespace, newlines included, becomes one space.

    Two plain patterns: one for other whitespace and runs of spaces alike costs four times as much.
    """
    return F.regexp_replace(F.regexp_replace(text, P.OTHER_SPACE, " "), "  +", " ")


def strip_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, f"^{P.WHITESPACE}+|{P.WHITESPACE}+$", "")


def remove_control_chars(text: Column, mode: str = "intent") -> Column:
    """``intent`` deletes control characters; ``parity`` deletes what the
    historical pattern really matched (see ``patterns.CONTROL_PARITY``)."""
    return F.regexp_replace(text, P.CONTROL_INTENT if mode == "intent" else P.CONTROL_PARITY, "")


def normalize_whitespace(text: Column) -> Column:
    """Runs of spaces to one, two or more newlines to two, ends stripped."""
    spaces = F.regexp_replace(text, " +", " ")
    return strip_whitespace(F.regexp_replace(spaces, "\n\n+", "\n\n"))


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, P.URL, "")


def remove_emails(text: Column) -> Column:
    # The substring test is far cheaper than the pattern and most texts fail it.
    return F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, P.EMAIL, "")).otherwise(text)


def scrub(text: Column, control_chars: str = "intent") -> Column:
    """Whitespace collapsed, ends stripped, control characters removed."""
    return remove_control_chars(F.trim(collapse_whitespace(text)), control_chars)


def shingle_text(text: Column) -> Column:
    return collapse_whitespace(F.lower(text))


def char_ngrams(text: Column, n: int) -> Column:
    """All character n-grams in text order, by code point.

    The look-ahead captures n code points and the trailing dot moves on by
    one, so characters outside the basic plane are never cut in half and the
    cost is linear in the length of the text.
    """
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1))


def shingles(text: Column, n: int) -> Column:
    """The set of character n-grams of the lower-cased, collapsed text."""
    return F.array_distinct(char_ngrams(shingle_text(text), n))
