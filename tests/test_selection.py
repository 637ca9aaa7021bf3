"""Rows by rank against Python's sort."""

from __future__ import annotations

import random

import pytest

from stormledger.operators import selection
from stormledger.operators.selection import Key, rows_between

SCHEMA = "a double, b string, `c.d` timestamp_ntz, n bigint"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def ordered(rows):
    """a descending with nulls last, then b ascending with nulls first, then n."""
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or "", r[3]))


KEYS = [Key("a", descending=True), Key("b"), Key("n")]


@pytest.fixture
def rows():
    rng = random.Random(5)
    values = [None, 0.1, 1e300, -2.5, 7.0]
    return [
        (rng.choice([*values, rng.random()]), rng.choice([None, "", "é", "x", "xy"]), None, n)
        for n in range(3000)
    ]


@pytest.mark.parametrize("low,high", [(0, 10), (1490, 1530), (2990, 3100), (700, 700), (3000, 3010)])
def test_ranks_equal_a_sort(spark, rows, low, high):
    found = rows_between(table(spark, rows), KEYS, low, high, few=100, drawn=200).collect()
    want = ordered(rows)
    assert {r.rank: r.n for r in found} == {i: want[i][3] for i in range(low, min(high, 3000))}


def test_only_rows_between_the_pivots_are_numbered(spark, rows, monkeypatch):
    sizes, number = [], selection.index_rows
    monkeypatch.setattr(
        selection, "index_rows", lambda df, *more: sizes.append(df.count()) or number(df, *more)
    )
    rows_between(table(spark, rows), KEYS, 1000, 1020, few=100, drawn=500).collect()
    assert sizes and sizes[0] <= 300


def test_bad_draws_lose_nothing(spark, rows, monkeypatch):
    """Draws whose weights say nothing about ranks."""
    drawn = selection._drawn

    def wrong(*args):
        return [(w * random.Random(i).choice([1, 40]), t) for i, (w, t) in enumerate(drawn(*args))]

    monkeypatch.setattr(selection, "_drawn", wrong)
    found = rows_between(table(spark, rows), KEYS, 1490, 1530, few=50, drawn=60).collect()
    want = ordered(rows)
    assert {r.rank: r.n for r in found} == {i: want[i][3] for i in range(1490, 1530)}


def test_equal_rows_and_empty_tables(spark):
    same = [(1.0, "x", None, 7)] * 500
    found = rows_between(table(spark, same), KEYS, 100, 120, few=10, drawn=5).collect()
    assert sorted(r.rank for r in found) == list(range(100, 120))
    assert rows_between(table(spark, []), KEYS, 0, 5).count() == 0
    assert rows_between(table(spark, same), [Key("c.d"), Key("n")], 0, 3, few=10).count() == 3
