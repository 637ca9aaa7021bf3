"""Tables that lie together: spine and payloads in buckets of the same keys.

Where both are saved in equally many buckets, each bucket of one meets its bucket of the other
where they lie, and attaching payloads moves neither. Runs add files to the buckets. A table's
files lie in the given folder; its name and buckets are known to the session's catalog, and a
session with another catalog registers the folder anew (``register``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stormledger.plans.articles import EVENT_KEY, attach_payloads

BUCKETS = 256  # one task reads a bucket: choose about the table's size by 128 MB
BUCKET_ROWS = 500_000  # where rows are narrow and their number decides, see buckets_for


def buckets_for(*tables: DataFrame, rows: int = BUCKET_ROWS, least: int = 8) -> int:
    """How many buckets keep those of the longest table at about ``rows`` rows, as a power of two.

    A task sorts a bucket when it is written and again when it meets the other table's, so
    buckets must become more, not longer, as tables grow.
    """
    longest = max(t.count() for t in tables)
    return max(least, 1 << max(0, -(-longest // rows) - 1).bit_length())


def save_bucketed(
    rows: DataFrame, table: str, path: str, keys: Sequence[str] = EVENT_KEY, buckets: int = BUCKETS
) -> None:
    """Add rows to a table of buckets by these keys, sorted by them within a file."""
    (
        rows.repartition(buckets, *keys)  # so that a bucket's rows of this run are one file
        .write.format("parquet")
        .mode("append")
        .option("path", path)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )


def register(
    spark: SparkSession,
    table: str,
    path: str,
    ddl: str,
    keys: Sequence[str] = EVENT_KEY,
    buckets: int = BUCKETS,
) -> None:
    """Tell this session's catalog about a table that another session has saved."""
    names = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet "
        f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )


def attach_saved(
    spark: SparkSession, events: str, payloads: str, *keep: str, keys: Sequence[str] = EVENT_KEY
) -> DataFrame:
    """``attach_payloads`` of two saved tables: no row is shuffled for it."""
    return attach_payloads(spark.table(events), spark.table(payloads), keys, *keep)
