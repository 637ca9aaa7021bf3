"""The rows between two ranks of an order, without sorting the table.

Pivots close in on the ranks. Each round draws rows from those that are still in question, every
one standing for the rows of its draw, so that weighted ranks among them estimate ranks in the
table. Two of them, a little before the first wanted rank and after the last, become pivots, and
one scan counts the rows up to each, exactly. A pivot that proves to lie on the wrong side is not
used, and the next round stays further away; so no row is lost, whatever was drawn. A round leaves
about a fiftieth of the rows. When few enough are left they are numbered, and the wanted ones taken.

A round scans the order's columns of the rows in question and shuffles the drawn rows alone. Rows
move once, those between the last two pivots. The driver gets the drawn rows' order columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormledger.operators.numbering import index_rows

DRAWN = 20_000  # rows a round, at most
SLACK = 0.01  # of the rows in question, on either side of the wanted ranks
ROUNDS = 12
FEW = 100_000  # rows that are numbered without a further round


@dataclass(frozen=True)
class Key:
    """A column to order by. Nulls come first in ascending and last in descending order."""

    name: str
    descending: bool = False

    @property
    def value(self) -> Column:
        return F.col(f"`{self.name}`")

    @property
    def sorting(self) -> Column:
        return self.value.desc() if self.descending else self.value.asc()

    def before(self, pivot: Column | None) -> Column:
        """Whether a row's value comes strictly before the pivot's; None is the null."""
        if self.descending:
            return self.value.isNotNull() if pivot is None else self.value > pivot
        return F.lit(False) if pivot is None else self.value.isNull() | (self.value < pivot)

    def after(self, pivot: Column | None) -> Column:
        if self.descending:
            return F.lit(False) if pivot is None else self.value.isNull() | (self.value < pivot)
        return self.value.isNotNull() if pivot is None else self.value > pivot


class _Pivot:
    """A place in the order. Its values came as text; any place will do, so nothing rests on
    their being those of a row to the last digit."""

    def __init__(self, df: DataFrame, keys: Sequence[Key], texts: Sequence[str | None]):
        self.keys = keys
        self.values = [
            None if text is None else F.lit(text).cast(df.schema[key.name].dataType)
            for key, text in zip(keys, texts)
        ]

    def _beyond(self, side: str) -> Column:
        """Rows strictly on one side: the first key that differs decides."""
        condition = F.lit(False)
        for key, value in reversed(list(zip(self.keys, self.values))):
            same = key.value.isNull() if value is None else key.value == value
            condition = getattr(key, side)(value) | (same & condition)
        return F.coalesce(condition, F.lit(False))

    def rows_before(self) -> Column:
        return self._beyond("before")

    def rows_after(self) -> Column:
        return self._beyond("after")

    def leading(self, side: str) -> Column:
        """What holds for the first key of every row that is not on this side; scans can use it."""
        return F.coalesce(~getattr(self.keys[0], side)(self.values[0]), F.lit(True))


def _drawn(rows: DataFrame, keys: Sequence[Key], number: int, seed: int) -> list[tuple]:
    """(weight, texts of the order's columns) of one row for each of so many draws, in order."""
    values = [k.value for k in keys]
    draw = F.pmod(F.xxhash64(F.lit(seed), *values), F.lit(number))
    chance = F.xxhash64(F.lit(~seed), *values)
    one = F.min(F.struct(chance.alias("chance"), *values)).alias("one")
    sample = (
        rows.groupBy(draw.alias("draw")).agg(F.count("*").alias("weight"), one).select("weight", "one.*")
    )
    texts = [k.value.cast("string") for k in keys]
    ordered = sample.orderBy(*[k.sorting for k in keys])
    return [(r[0], tuple(r[1:])) for r in ordered.select("weight", *texts).collect()]


def rows_between(
    df: DataFrame,
    keys: Sequence[Key],
    low: int,
    high: int,
    index: str = "rank",
    few: int = FEW,
    drawn: int = DRAWN,
) -> DataFrame:
    """The rows whose 0-based rank in the order is in [low, high), with that rank.

    Rows that tie in all keys have ranks in any order, so keys should tell rows apart.
    """
    columns = [k.value for k in keys]
    size = df.count()
    low, high = max(low, 0), min(high, size)
    inside, earlier, slack = F.lit(True), 0, SLACK
    for attempt in range(ROUNDS):
        if low >= high or size <= max(few, 2 * (high - low)):
            break
        rows = df.where(inside)
        first = last = None
        seen, margin = earlier, slack * size
        for weight, texts in _drawn(rows.select(*columns), keys, drawn, attempt):
            if seen + weight <= low - margin:
                first = texts
            if last is None and seen >= high + margin:
                last = texts
            seen += weight
        pivots = [None if t is None else _Pivot(df, keys, t) for t in (first, last)]
        nothing = F.lit(0).cast("bigint")
        counted = rows.agg(
            nothing if pivots[0] is None else F.count_if(pivots[0].rows_before()),
            nothing if pivots[1] is None else F.count_if(pivots[1].rows_after()),
        ).first()
        before, after = counted
        good = [before and earlier + before <= low, after and earlier + size - after >= high]
        if good[0]:
            inside = inside & pivots[0].leading("before") & ~pivots[0].rows_before()
            earlier, size = earlier + before, size - before
        if good[1]:
            inside = inside & pivots[1].leading("after") & ~pivots[1].rows_after()
            size -= after
        if not any(good):
            slack *= 4
    kept = df.where(inside) if low < high else df.limit(0)
    ranked = index_rows(kept, [k.sorting for k in keys], index)
    ranked = ranked.withColumn(index, F.col(index) + earlier)
    return ranked.where((F.col(index) >= low) & (F.col(index) < high))
