"""CSV files with quoted line breaks, read by many tasks.

Whether a line break ends a record depends on the quotes before it, back to the start of the
file. So files are cut at any line into chunks of about a megabyte, and each chunk is read twice:
as if it began between records, and as if it began inside quotes. A chunk then is a function from
the state before it to the state after it. These functions are composed along each file, on one
small row per chunk, which tells every chunk its true state and the number of its first record.
Records that begin and end in a chunk are read there; those that cross a border come in fragments,
which alone are shuffled, joined and read.

Records, cells and their numbers are those of Python's csv module on a file opened with
``newline=""``: LF, CRLF and CR end lines, empty lines are no records, quotes count at the start
of a cell only. Unlike there, cells may have any length, and quotes that are still open at the end
of a file do not hold its last line break.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stormledger.storage import durable, workers_find_package

CHUNK_BYTES = 1 << 20
RECORD_BYTES = 256 << 20  # a longer record is taken for a quote that was never closed
_CHUNK = pa.schema(
    [
        ("file", pa.string()),
        ("block", pa.int64()),
        ("chunk", pa.int64()),
        ("text", pa.string()),
        ("out0", pa.bool_()),
        ("starts0", pa.int64()),
        ("tail0", pa.string()),
        ("out1", pa.bool_()),
        ("starts1", pa.int64()),
        ("tail1", pa.string()),
        ("head", pa.string()),
        ("names", pa.list_(pa.string())),
    ]
)
_CHUNK_DDL = (
    "file string, block bigint, chunk bigint, text string, out0 boolean, starts0 bigint, "
    "tail0 string, out1 boolean, starts1 bigint, tail1 string, head string, names array<string>"
)


def _lines(text: str) -> list[str]:
    """Lines with their ends, of whichever kind."""
    return list(io.StringIO(text, newline=""))


def _head(lines: list[str]) -> int | None:
    """How many lines the record takes that is open before them; None for more than there are."""
    reader = csv.reader(iter(['"' + lines[0], *lines[1:], "\n"]))
    next(reader)
    return reader.line_num if reader.line_num <= len(lines) else None


def split_records(text: str, opened: bool) -> tuple[str, list[list[str]], str, bool]:
    """(head, records, tail, open after it): what ends an open record, what is whole, what
    begins a record that goes on."""
    csv.field_size_limit(sys.maxsize)
    lines = _lines(text)
    first = _head(lines) if opened else 0
    if first is None:
        return text, [], "", True
    rest = lines[first:]
    reader = csv.reader(iter([*rest, "\n"]))
    records, done = [], 0
    for cells in reader:
        if reader.line_num > len(rest):  # the line added at the end
            break
        done = reader.line_num
        if cells:
            records.append(cells)
    return "".join(lines[:first]), records, "".join(rest[done:]), done < len(rest)


def _chunk_row(file: str, block: int, chunk: int, lines: list[bytes]) -> dict:
    text = b"".join(lines).decode("utf-8", "replace")
    _, records0, tail0, out0 = split_records(text, False)
    head, records1, tail1, out1 = split_records(text, True)
    return {
        "file": file,
        "block": block,
        "chunk": chunk,
        "text": text,
        "out0": out0,
        "starts0": len(records0) + bool(tail0),
        "tail0": tail0,
        "out1": out1,
        "starts1": len(records1) + bool(tail1),
        "tail1": tail1,
        "head": head,
        "names": records0[0] if records0 and (block, chunk) == (0, 0) else None,
    }


def chunks(spark: SparkSession, path: str | list[str], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The files' chunks, each with what it does to either state; written to the shared folder."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, chunk, lines, size = None, 0, [], 0

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_chunk_row(*place, chunk, lines)], _CHUNK)

        for batch in batches:
            for file, block, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, block) != place or size >= chunk_bytes:
                    if lines:
                        yield sent()
                    chunk = chunk + 1 if (file, block) == place else 0
                    place, lines, size = (file, block), [], 0
                lines.append(line + b"\n")
                size += len(line) + 1
        if lines:
            yield sent()

    workers_find_package(spark)
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").cast("binary").alias("line"),
        )
    )
    return durable(lines.mapInArrow(packed, _CHUNK_DDL))


def entries(made: DataFrame) -> DataFrame:
    """(file, block, chunk, opened, first, starts): each chunk's state and first record's number.

    Chunks either keep the state, flip it, or set it, whatever it was. So the state is the last
    one set, flipped as often as chunks since then flip it.
    """
    upto = W.partitionBy("file").orderBy("block", "chunk").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy("file").orderBy("block", "chunk").rowsBetween(W.unboundedPreceding, -1)
    flips = F.sum((F.col("out0") & ~F.col("out1")).cast("bigint"))
    sets = F.when(F.col("out0") == F.col("out1"), F.struct("out0", "flipped"))
    odd = (F.col("earlier") - F.coalesce("set.flipped", F.lit(0))) % 2 == 1
    states = (
        made.select("file", "block", "chunk", "out0", "starts0", "out1", "starts1")
        .select("*", flips.over(upto).alias("flipped"))
        .select(
            "*",
            F.coalesce(flips.over(before), F.lit(0)).alias("earlier"),
            F.last(sets, ignorenulls=True).over(before).alias("set"),
        )
        .select("*", (F.coalesce("set.out0", F.lit(False)) != odd).alias("opened"))
        .withColumn("starts", F.when(F.col("opened"), F.col("starts1")).otherwise(F.col("starts0")))
    )
    first = F.coalesce(F.sum("starts").over(before), F.lit(0))
    return states.select("file", "block", "chunk", "opened", first.alias("first"), "starts")


def _whole_records(placed: DataFrame) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                records = split_records(row["text"], row["opened"])[1]
                yield _records_batch(row["file"], row["first"], records)

    return placed.select("file", "text", "opened", "first").mapInArrow(read, _RECORD_DDL)


def _records_batch(file: str, first: int, records: list[list[str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([file] * len(records), pa.string()),
            pa.array(range(first, first + len(records)), pa.int64()),
            pa.array(records, pa.list_(pa.string())),
        ],
        ["file", "record", "cells"],
    )


_RECORD_DDL = "file string, record bigint, cells array<string>"


def _crossing_records(placed: DataFrame) -> DataFrame:
    """Records in fragments: put together, then read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)
        for batch in batches:
            for row in batch.to_pylist():
                text = row["text"]
                if split_records(text, False)[3]:  # the file ends before the quotes do
                    text = text.removesuffix("\n")
                cells = next(csv.reader(iter(_lines(text))))
                yield _records_batch(row["file"], row["record"], [cells])

    return placed.mapInArrow(read, _RECORD_DDL)


def _fragments(placed: DataFrame) -> DataFrame:
    """(file, record, text) of the records that cross a border between chunks."""
    tail = F.when(F.col("opened"), F.col("tail1")).otherwise(F.col("tail0"))
    last = F.col("first") + F.col("starts") - 1
    pieces = F.filter(
        F.array(
            F.struct(
                (F.col("first") - 1).alias("record"),
                F.when(F.col("opened"), F.col("head")).alias("text"),
            ),
            F.struct(last.alias("record"), tail.alias("text")),
        ),
        lambda p: F.coalesce(p["text"], F.lit("")) != "",
    )
    place = F.struct("block", "chunk", F.col("piece.text").alias("text"))
    parts = placed.select("file", "block", "chunk", F.explode(pieces).alias("piece")).groupBy(
        "file", F.col("piece.record").alias("record")
    )
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(place)), lambda p: p["text"]), "")
    unclosed = F.raise_error(F.concat(F.lit("a quote is never closed in "), F.col("file")))
    size = F.sum(F.octet_length("piece.text"))
    return parts.agg(
        F.when(size <= RECORD_BYTES, joined).otherwise(unclosed.cast("string")).alias("text")
    )


def _records(placed: DataFrame) -> DataFrame:
    return _whole_records(placed).unionByName(_crossing_records(_fragments(placed)))


def records(spark: SparkSession, path: str | list[str], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(file, record, cells): every record of every file, numbered from 0, headers included."""
    made = chunks(spark, path, chunk_bytes)
    return _records(made.join(entries(made), ["file", "block", "chunk"]))


def _header(made: DataFrame, path: str | list[str]) -> list[str]:
    """The first record of every file, which has to be the same in all."""
    begins = made.where("block = 0 AND chunk = 0").select("names").distinct().limit(3).collect()
    found = {tuple(r.names) for r in begins if r.names}
    if len(found) != 1 or len(begins) > 1:  # else it may lie further on, or in fragments
        placed = made.join(entries(made), ["file", "block", "chunk"])
        # a chunk from which the first record starts has no earlier one
        starting = _records(placed.where("first = 0 OR (opened AND first = 1)")).where("record = 0")
        found = {tuple(r.cells) for r in starting.select("cells").distinct().limit(2).collect()}
    if len(found) != 1:
        raise ValueError(f"{'no' if not found else 'more than one'} header in {path}")
    return list(found.pop())


def column_names(header: list[str]) -> list[str]:
    """A header's names; empty ones and repeats (whatever their case) get their place."""
    lowered = [name.lower() for name in header]
    return [
        f"_c{i}" if not name else f"{name}{i}" if lowered.count(name.lower()) > 1 else name
        for i, name in enumerate(header)
    ]


def read_numbered_csv(
    spark: SparkSession,
    path: str | list[str],
    index: str = "row_index",
    file: str = "file",
    across_files: bool = False,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """All-string rows under the header's names, with their file and 0-based number.

    Rows count per file, or with ``across_files`` through all files in path order. Cells that a
    row lacks are NULL, those beyond the header are left out. Files that disagree on the header
    are an error; a file without any record has no header and no rows.
    """
    made = chunks(spark, path, chunk_bytes)
    known = entries(made)
    placed = made.join(known, ["file", "block", "chunk"])
    names = column_names(_header(made, path))
    rows = _records(placed).where("record > 0")
    number: Column = F.col("record") - 1
    if across_files:
        sizes = known.groupBy("file").agg(
            F.greatest(F.max(F.col("first") + F.col("starts")) - 1, F.lit(0)).alias("size")
        )
        earlier = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
        offset = F.coalesce(F.sum("size").over(earlier), F.lit(0))
        rows = rows.join(sizes.select("file", offset.alias("offset")), "file")
        number = number + F.col("offset")
    cells = [F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(names)]
    return rows.select(*cells, F.col("file").alias(file), number.alias(index))
