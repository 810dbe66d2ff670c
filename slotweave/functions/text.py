"""Text functions: cleaning, tokenising, brand containment.

Everything here is a built-in expression that takes part in whole-stage code
generation; no function holds a lambda, so none falls back to interpreted mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The blanks of a Python str are Unicode white space and four separators.
# (?U) is far faster here than the spelled-out ranges.
BLANK_RUN = r"(?U)[\s\x1c-\x1f]+"
# Punctuation that becomes a token of its own.
PUNCTUATION = ".,!?;:"
# Marks that are rewritten to an apostrophe.
QUOTE_MARKS = '"`´'

_GLUED_PUNCTUATION = f"([{PUNCTUATION}])(?=[^ ])"
# Text without any of these is clean already; most slot values are, and skip the rewriting.
_UNTIDY = rf"^ | $|  |[^ -~]|[{QUOTE_MARKS}]|[{PUNCTUATION}][^ ]"
_WORD_BEFORE_PUNCTUATION = f"([^ ])(?=[{PUNCTUATION}])"


def clean_text(text: Column) -> Column:
    """Blank runs become one space, punctuation is followed by a space, quotes become ``'``.

    NULL gives the empty string. Cleaning twice changes nothing.
    """
    spaced = F.regexp_replace(text, _GLUED_PUNCTUATION, "$1 ")
    for mark in QUOTE_MARKS:
        spaced = F.replace(spaced, F.lit(mark), F.lit("'"))
    tidied = F.trim(F.regexp_replace(spaced, BLANK_RUN, " "))
    return F.when(text.isNull(), "").when(F.rlike(text, F.lit(_UNTIDY)), tidied).otherwise(text)


def token_line(cleaned: Column) -> Column:
    """Tokens of a cleaned text, joined by single spaces ('' when there is none)."""
    return F.regexp_replace(cleaned, _WORD_BEFORE_PUNCTUATION, "$1 ")


def split_line(line: Column) -> Column:
    """Array of the tokens in a token line; the empty line has no tokens."""
    return F.array_remove(F.split(line, " "), "")


def tokenize_query(query: Column) -> Column:
    """Clean a query and split it into tokens, punctuation standing alone."""
    return split_line(token_line(clean_text(query)))


def is_brand_in_query(brand: Column, query: Column) -> Column:
    """Case-insensitive substring test on the cleaned texts; false when either is missing."""
    return contains_brand(clean_text(brand), clean_text(query))


def contains_brand(cleaned_brand: Column, cleaned_query: Column) -> Column:
    """``is_brand_in_query`` for texts that are clean already."""
    return (cleaned_brand != "") & F.contains(F.lower(cleaned_query), F.lower(cleaned_brand))
