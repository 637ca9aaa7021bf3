"""String expressions that follow Python's string rules rather than Spark's defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormledger.functions.fixed import COUNTY_SUFFIX_WORDS

# Every character str.strip() and str.split() treat as white space; the last is U+3000.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# The same set as a regex class: (?U)\s lacks the four separators U+001C..U+001F.
WHITESPACE_CLASS = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Trim white space of any kind from both ends (plain ``trim`` drops blanks only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """``strip(text) == ""``, decided at the first character that is no white space: trimming a
    long text at its end looks at all of it."""
    return F.ltrim(text, F.lit(WHITESPACE)) == ""


def safe_trim(text: Column) -> Column:
    """``strip`` with NULL read as the empty string."""
    return strip(F.coalesce(text, F.lit("")))


def nullif_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def field_fallback(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor empty, else the empty string."""
    return F.coalesce(*[nullif_empty(c) for c in candidates], F.lit(""))


def first_segment(text: Column) -> Column:
    """Text before the first comma, trimmed."""
    return strip(F.substring_index(text, ",", 1))


def remove_words(text: Column, words: Sequence[str]) -> Column:
    """Drop whole words in any case, trim, and close gaps of two or more spaces.

    One alternation replaces one pass per word: no removal can form a new word, so
    the order of the list does not matter as long as longer phrases do not contain
    an earlier word.
    """
    pattern = r"(?iU)\b(?:" + "|".join(words) + r")\b"
    without = strip(F.regexp_replace(text, pattern, ""))
    return F.regexp_replace(without, "(?U)" + WHITESPACE_CLASS + "{2,}", " ")


def clean_name(label: Column) -> Column:
    """County label ("Miami-Dade County, Florida") to its bare name ("Miami-Dade")."""
    return remove_words(first_segment(label), COUNTY_SUFFIX_WORDS)
