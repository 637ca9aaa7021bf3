"""Keep-first and keep-last.

All forms aggregate: each task reduces its rows to one per key before the shuffle, so
a key that holds a third of the table sends one row per task.

Rows that tie in the given order are told apart by their other columns, so the result
does not depend on how the table is cut into tasks. Map columns cannot be compared and
are not supported.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormledger.functions.urls import url_base


def _one_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], pick: Callable
) -> DataFrame:
    named = [o for o in order if isinstance(o, str)]
    leading = [
        F.col(o) if isinstance(o, str) else o.alias(f"_order_{i}") for i, o in enumerate(order)
    ]
    # A key is carried once, by the grouping, and not again inside the compared struct.
    rest = [c for c in df.columns if c not in named and c not in keys]
    return (
        df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys])
        .agg(pick(F.struct(*leading, *rest) if leading or rest else F.lit(0)).alias("_row"))
        .select(
            *[
                F.col(f"`_key_{c}`").alias(c) if c in keys else F.col(f"_row.`{c}`").alias(c)
                for c in df.columns
            ]
        )
    )


def keep_first(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """The row of every key that comes first in ascending ``order``."""
    return _one_per_key(df, keys, order, F.min)


def keep_last(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """The row of every key that comes last in ascending ``order``."""
    return _one_per_key(df, keys, order, F.max)


def dedup_then_filter(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], condition: Column
) -> DataFrame:
    """First row per key, dropped if it fails: a later good copy does not replace it."""
    return keep_first(df, keys, *order).where(condition)


def filter_then_dedup(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], condition: Column
) -> DataFrame:
    """First row per key among the rows that pass."""
    return keep_first(df.where(condition), keys, *order)


def keep_first_url(df: DataFrame, url: str, *order: Column | str) -> DataFrame:
    """One row per URL without its query part, over all events.

    Rows are grouped by the URL's hash first and then by the URL: sorted by URL alone they would
    all be compared in full, since URLs begin alike.
    """
    base = url_base(F.col(url))
    based = df.withColumns({"_hash": F.xxhash64(base), "_base": base})
    return keep_first(based, ["_hash", "_base"], *order).drop("_hash", "_base")
