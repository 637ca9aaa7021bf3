"""Grouping operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormledger.functions.arrays import let


def first_by(rows: Column, key: str, position: str = "article_pos") -> Column:
    """Of an array of structs, the first one of every key, by position."""
    keyed = F.array_sort(
        F.transform(
            rows, lambda r: F.struct(r[key].alias("k"), r[position].alias("p"), r.alias("r"))
        )
    )
    return let(
        keyed,
        lambda x: F.transform(
            F.filter(
                x, lambda e, i: F.coalesce(F.get(x, i - 1)["k"] != e["k"], F.lit(True))
            ),
            lambda e: e["r"],
        ),
    )


def articles_by_date(
    rows: Column, date: str, fields: Sequence[str], position: str = "article_pos"
) -> Column:
    """array<struct<date, articles>>, newest date first, articles by position.

    Groups the rows of one payload inside its row: nothing is shuffled, and a group is
    never larger than the payload that it came in.
    """

    def grouped(of: Column) -> Column:
        dates = F.sort_array(F.array_distinct(F.transform(of, lambda r: r[date])), asc=False)
        return F.transform(
            dates,
            lambda d: F.struct(
                d.alias("date"),
                F.transform(
                    F.array_sort(
                        F.transform(
                            F.filter(of, lambda r: r[date] == d),
                            lambda r: F.struct(r[position].alias("p"), r.alias("r")),
                        )
                    ),
                    lambda e: F.struct(*[e["r"][f].alias(f) for f in fields]),
                ).alias("articles"),
            ),
        )

    return let(rows, grouped)


def progress_rollup(
    work_keys: DataFrame, articles: DataFrame, keys: Sequence[str], date: str
) -> DataFrame:
    """Date groups and articles per work key; keys without articles count 0.

    Grouping by date first makes both numbers plain sums, with no distinct count.
    """
    per_date = articles.groupBy(*keys, date).agg(F.count("*").alias("_n"))
    per_key = per_date.groupBy(*keys).agg(
        F.count("*").alias("date_groups"), F.sum("_n").alias("articles")
    )
    zero = F.lit(0).cast("bigint")
    return work_keys.join(per_key, list(keys), "left").select(
        *[c for c in work_keys.columns],
        F.coalesce("date_groups", zero).alias("date_groups"),
        F.coalesce("articles", zero).alias("articles"),
    )


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def run_totals(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: all rows, and the rows meeting each named condition."""
    return df.agg(
        F.count("*").alias("rows_processed"),
        *[F.count_if(c).alias(name) for name, c in conditions.items()],
    )
