"""Expressions over arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once however often ``body`` names it.

    A plain column would be copied into a lambda of ``body`` and computed per element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


RUN = 256  # values whose running results are made together


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running results over an array of int, from 0. Long arrays are cut into runs, so that no
    array is copied once per value."""

    def results(of: Column) -> Column:
        def step(made: Column, x: Column) -> Column:
            last = F.coalesce(F.get(made, F.size(made) - 1), F.lit(0))
            return F.concat(made, F.array(combine(last, x)))

        return F.aggregate(of, F.array().cast("array<int>"), step)

    def joined(runs: Column) -> Column:
        totals = results(F.transform(runs, lambda r: F.get(r, F.size(r) - 1)))
        return let(
            totals,
            lambda before: F.flatten(
                F.transform(
                    runs,
                    lambda r, i: F.transform(
                        r, lambda x: combine(F.coalesce(F.get(before, i - 1), F.lit(0)), x)
                    ),
                )
            ),
        )

    def cut(of: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(of), F.lit(1)), F.lit(RUN))
        return let(F.transform(starts, lambda at: results(F.slice(of, at, RUN))), joined)

    return let(values, cut)
