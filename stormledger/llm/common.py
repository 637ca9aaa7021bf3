"""Column helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.functions.arrays import let

SPACES = r"[\x20\x09-\x0D]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def whole_row(rows: DataFrame) -> Column:
    """All columns as one struct, whatever their names hold."""
    return F.struct(*[F.col("`" + name.replace("`", "``") + "`") for name in rows.columns])


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone. Pure ASCII texts take the fast built-in."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def space_words(text: Column) -> Column:
    """Words are runs of anything but ASCII white space."""
    return F.array_remove(F.split(text, SPACES), "")


def letter_words(text: Column) -> Column:
    """Words are runs of digits, lower-case letters and anything outside ASCII."""
    return F.array_remove(F.split(ascii_lower(text), NOT_WORD), "")


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def grams(hashes: Column, n: int) -> Column:
    """One 64-bit hash for every n consecutive entries; empty for shorter arrays."""
    return let(
        hashes,
        lambda of: F.when(
            F.size(of) >= n,
            F.transform(
                F.sequence(F.lit(0), F.size(of) - F.lit(n)),
                lambda i: F.xxhash64(*[F.get(of, i + F.lit(j)) for j in range(n)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
