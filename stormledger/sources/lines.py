"""Physical lines of text files: counting and numbering."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.functions.text import strip
from stormledger.operators.numbering import index_within_blocks
from stormledger.storage import durable


def count_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """One row: number of lines that are not blank."""
    return lines.where(strip(F.col(text)) != "").agg(F.count("*").alias("lines"))


def count_csv_rows(lines: DataFrame, text: str = "value") -> DataFrame:
    """The same estimate for a CSV file: without its header, never below 0."""
    return count_lines(lines, text).select(F.greatest(F.col("lines") - 1, F.lit(0)).alias("rows"))


def number_lines(
    spark: SparkSession,
    path: str,
    across_files: bool = False,
    more: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(file, line_index, value): the 0-based physical line, blank lines included.

    ``more`` names further columns made of ``value``, written down with the lines, so that
    they are computed once.

    Lines count per file, or with ``across_files`` through all files in path order, as
    if the folder's parts were one file.

    A file is read in blocks by many tasks. Each block is counted, and a running sum
    over the blocks (not over the lines) gives every block its first index. The tagged
    lines are written down first: counting and numbering must see the same blocks, and
    a later read may cut files differently on a changed cluster.
    """
    tagged = durable(
        spark.read.text(path).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_seq"),
            "value",
            *[column.alias(name) for name, column in (more or {}).items()],
        )
    )
    group, block = ([], ["file", "_block"]) if across_files else (["file"], ["_block"])
    return index_within_blocks(tagged, group, block, "_seq", "line_index")
