"""Order-based operators: top n per group, page slices, seeded order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stormledger.functions.fixed import PAGE_SIZE
from stormledger.operators.numbering import index_rows
from stormledger.operators.selection import Key, rows_between


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """First ``n`` rows of every group in ``order``.

    Spark turns the filter on ``row_number`` into a per-task limit before the shuffle,
    so a hot group sends at most ``n`` rows per task.
    """
    ranked = df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) <= n)


def page_slice(
    df: DataFrame,
    order: Sequence[Key | str | Column],
    skip: int = 0,
    pages: int = 1,
    size: int = PAGE_SIZE,
) -> DataFrame:
    """``pages`` pages of ``size`` rows after the first ``skip`` rows of ``order``.

    ``order`` needs a tie-break to be repeatable. Ordered by keys or names, the table is neither
    sorted nor written: pivots are found on both sides of the slice, however deep it lies, and
    only the rows between them are. An order of other expressions is sorted as a whole.
    """
    end = skip + pages * size
    if all(isinstance(o, (Key, str)) for o in order):
        keys = [Key(o) if isinstance(o, str) else o for o in order]
        return rows_between(df, keys, skip, end, "_rank").drop("_rank")
    numbered = index_rows(df, order, "_index")
    return numbered.where((F.col("_index") >= skip) & (F.col("_index") < end)).drop("_index")


def ordered(
    df: DataFrame, order: Sequence[Column | str], place: str = "place"
) -> DataFrame:
    """The rows in ``order`` over the whole table, with their 0-based place in it."""
    return index_rows(df, order, place)


def seeded_order(
    df: DataFrame, keys: Sequence[str], seed: int, place: str = "place"
) -> DataFrame:
    """A shuffled order, the same in every run with the same seed, as 0-based places.

    Rows are ordered by the SHA-1 of seed and keys, which any other engine has too.
    """
    spelled = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return index_rows(df, [F.sha1(spelled), *keys], place)
