"""Keys that different values happen to share, found and told apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormledger.storage import durable


def conflicts(rows: DataFrame, key: str, full: Column, issued: DataFrame | None = None) -> DataFrame:
    """(key, owner) of the keys that rows with different ``full`` values share.

    The owner is the value that keeps the key: the one that had it before, in ``issued`` (key,
    owner), or else the smallest. A task sends one row per key and value range, so copies of a
    row cost nothing.
    """
    here = rows.select(F.col(key).alias("key"), full.alias("_full"), F.lit(1).alias("_late"))
    if issued is not None:
        kept = issued.select("key", F.col("owner").alias("_full"), F.lit(0).alias("_late"))
        here = here.unionByName(kept)
    return (
        here.where(F.col("key").isNotNull() & F.col("_full").isNotNull())
        .groupBy("key")
        .agg(
            F.min(F.struct("_late", "_full"))["_full"].alias("owner"),
            F.min("_full").alias("_low"),
            F.max("_full").alias("_high"),
        )
        .where("_low <> _high")
        .select("key", "owner")
    )


def told_apart(
    rows: DataFrame, key: str, full: Column, wide: Column, issued: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows, conflicts): the rows with ``wide`` as their key where the key belongs to another.

    A wide key depends on its row alone, and with ``issued`` an owner stays, so that keys are
    the same in every run. Conflicts are rare and written down; their size being known, Spark
    broadcasts them where they are few.
    """
    found = durable(conflicts(rows, key, full, issued))
    owners = found.select(F.col("key").alias("_shared_key"), F.col("owner").alias("_owner"))
    columns = [F.col(f"`{c}`") for c in rows.columns if c != key]
    other = F.col("_owner").isNotNull() & (full != F.col("_owner"))
    apart = rows.join(owners, F.col(key) == F.col("_shared_key"), "left").withColumn(
        "_key", F.when(other, wide).otherwise(F.col(key))
    )
    return apart.select(F.col("_key").alias(key), *columns), found
