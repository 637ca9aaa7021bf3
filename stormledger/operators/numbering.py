"""Row numbers over a whole table without one task seeing the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stormledger.functions.fixed import CHUNK_SIZE
from stormledger.storage import durable


def index_within_blocks(
    rows: DataFrame, group: Sequence[str], block: Sequence[str], seq: str, index: str
) -> DataFrame:
    """Number the rows of each group from 0, given the blocks that make it up.

    ``seq`` rises inside a block and has no gaps there. Columns named with a leading
    underscore are taken out again. Only the blocks' (first, size)
    pairs are sorted, one small row for each file block or task; where there is no group
    one task sorts them all. ``rows`` must be durable, since it is read twice: once to count
    the blocks and once to number the rows.
    """
    keys = [*group, *block]
    sizes = rows.groupBy(*keys).agg(F.min(seq).alias("_first"), F.count("*").alias("_size"))
    earlier = W.orderBy(*(block or group)).rowsBetween(W.unboundedPreceding, -1)
    if group:
        inside = W.partitionBy(*group).orderBy(*(block or group))
        earlier = inside.rowsBetween(W.unboundedPreceding, -1)
    offsets = durable(
        sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).drop("_size")
    )
    return (
        rows.join(offsets, keys)
        .withColumn(index, F.col("_offset") + F.col(seq) - F.col("_first"))
        .drop(*[b for b in block if b.startswith("_")], seq, "_first", "_offset")
    )


def index_rows(
    df: DataFrame,
    order: Sequence[Column | str],
    index: str = "row_index",
    group: Sequence[str] = (),
) -> DataFrame:
    """Number all rows, or the rows of each group, from 0 in ``order`` without ties.

    A range-partitioned sort leaves every partition a contiguous run, and cuts a large
    group over several. The sorted partitions are written down, counted, and shifted by
    the rows before them; the window runs over one row per partition and group.
    """
    ordered = durable(
        df.orderBy(*group, *order).select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().alias("_seq"),
        )
    )
    return index_within_blocks(ordered, group, ["_part"], "_seq", index)


def assign_chunks(
    df: DataFrame,
    order: Sequence[Column | str],
    size: int = CHUNK_SIZE,
    max_chunks: int | None = None,
) -> DataFrame:
    """Fixed-size chunks in ``order``; the last may be short. ``max_chunks`` keeps the
    first few only, as a run limit."""
    chunked = index_rows(df, order, "_index").withColumn(
        "chunk", F.floor(F.col("_index") / size)
    )
    if max_chunks is not None:
        chunked = chunked.where(F.col("chunk") < max_chunks)
    return chunked.withColumn("pos_in_chunk", F.col("_index") % size).drop("_index")
