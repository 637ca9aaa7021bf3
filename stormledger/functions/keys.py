"""Stable row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormledger.functions.text import safe_trim

# The fields that make the key, and the mark of a fallback key.
KEY_PARTS = ("disasterNumber", "county_fips", "url")
FALLBACK_MARK = "missingpk"
HASH_DIGITS = 10


def _parts(number: Column, fips: Column, url: Column) -> tuple[Column, Column, Column]:
    return safe_trim(number.cast("string")), safe_trim(fips.cast("string")), safe_trim(url)


def key_is_missing(number: Column, fips: Column, url: Column) -> Column:
    """True where a part of the key is empty and the fallback applies."""
    number, fips, url = _parts(number, fips, url)
    return (number == "") | (fips == "") | (url == "")


def row_key(number: Column, fips: Column, url: Column) -> Column:
    """``number_fips_hash`` over the trimmed parts; the whole URL is hashed."""
    number, fips, url = _parts(number, fips, url)
    return F.concat_ws("_", number, fips, F.substring(F.sha1(url), 1, HASH_DIGITS))


def full_hash(url: Column) -> Column:
    """All digits of the hash that a key shows the first of."""
    return F.sha1(safe_trim(url))


def wide_key(number: Column, fips: Column, url: Column) -> Column:
    """A key with the whole hash, for a row whose short key another URL has."""
    number, fips, url = _parts(number, fips, url)
    return F.concat_ws("_", number, fips, F.sha1(url))


def fallback_key(file_kind: str, index: Column) -> Column:
    """``missingpk_csv_3``: marks a row by its place in its file."""
    return F.concat_ws("_", F.lit(FALLBACK_MARK), F.lit(file_kind), index.cast("string"))


def row_key_or_fallback(
    number: Column, fips: Column, url: Column, file_kind: str, index: Column
) -> Column:
    return F.when(key_is_missing(number, fips, url), fallback_key(file_kind, index)).otherwise(
        row_key(number, fips, url)
    )


def missing_parts(number: Column, fips: Column, url: Column) -> Column:
    """Names of the key parts that a row lacks, joined by commas; NULL if none."""
    parts = _parts(number, fips, url)
    lacking = [
        F.when(part == "", F.lit(name)) for name, part in zip(KEY_PARTS, parts)
    ]
    return F.when(key_is_missing(number, fips, url), F.concat_ws(",", *lacking))
