"""Blocks of documents that exchange compact tables of hashes.

Counting how often every hash of a corpus occurs needs no row per hash. Documents are dealt
over blocks of a few megabytes. Each block sends, for every bin of hash values, its distinct
hashes in order as one binary cell; so a hash that one block holds a million times is sent
once. A bin sees a hash from all blocks and answers each block with one small cell, in the
order it was asked. Blocks then meet their answers in a second grouping by block, for which
Spark reuses the first shuffle of the texts.

Blocks are ranges of the id, so that of two blocks the smaller has the smaller ids. Rows
without id lie in further blocks by their text. Ids may be of any type that has an order; of
texts the first seven bytes decide on the block.

The number of blocks, which is also that of the bins, follows from the bytes of all texts.
Beyond ``EVEN_BYTES`` a block grows with the root of the corpus, up to ``GROWTH`` times, so
that cells keep several hashes. What the plan holds does not grow: it has at most ``KNOTS``
ids, found as quantiles, and blocks between two of them are even steps.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormledger.functions.arrays import let
from stormledger.llm.fingerprints import pack_planes, unpack_planes

BLOCK_BYTES = 6_000_000
EVEN_BYTES = 100_000_000_000  # of all texts, up to which a block has these bytes
GROWTH = 8
KNOTS = 1024
_LEAD = 7  # bytes of a text id that make its number
ASK = "block int, bin int, hashes binary"
ANSWER = "block int, bin int, answer binary"


def _range_of(value: Column, bounds: list) -> Column:
    """How many bounds are at or below the value: two short scans instead of a long one."""
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.lit(bounds[step - 1 :: step]) if bounds else None
    if coarse is None:
        return F.lit(0)
    every = F.lit(bounds)
    rows = F.size(F.filter(coarse, lambda b: b <= value))
    rest = F.slice(every, rows * step + 1, F.lit(step))
    return rows * step + F.size(F.filter(rest, lambda b: b <= value))


def _number(docs: DataFrame) -> Column:
    """A number for the id that never falls as the id grows."""
    kind = docs.schema["doc_id"].dataType
    if isinstance(kind, T.NumericType):
        return F.col("doc_id")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        lead = F.substring(F.col("doc_id").cast("binary"), 1, _LEAD)
        return F.conv(F.rpad(F.hex(lead), 2 * _LEAD, "0"), 16, 10).cast("bigint")
    return F.col("doc_id").cast("timestamp").cast("bigint")  # a date or a time


def _block_of(number: Column, knots: list, low, high, steps: int) -> Column:
    """Which of ``steps`` even steps between which two knots the number lies in."""
    at = _range_of(number, knots)
    if steps == 1:
        return at
    edges = F.lit([float(x) for x in (low, *knots, high)])

    def step(k: Column) -> Column:
        begin, end = F.get(edges, k), F.get(edges, k + 1)
        share = F.when(end > begin, (number.cast("double") - begin) / (end - begin)).otherwise(0.0)
        inside = F.floor(share * steps).cast("int")
        return k * steps + F.greatest(F.lit(0), F.least(F.lit(steps - 1), inside))

    return let(at, step)


def dealt(
    docs: DataFrame, block_bytes: int = BLOCK_BYTES, extra: tuple[Column, ...] = ()
) -> tuple[DataFrame, int, int]:
    """(doc_id, text, extra, block), null text as empty; the number of id blocks; of bins."""
    number = _number(docs)
    total, ids, low, high = docs.agg(
        F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(16)),
        F.count("doc_id"),
        F.min(number),
        F.max(number),
    ).first()
    total = total or 0
    grown = block_bytes * min(GROWTH, max(1.0, (total / EVEN_BYTES) ** 0.5))
    blocks = max(1, round(total / grown))
    ranges = min(blocks, KNOTS)
    steps = -(-blocks // ranges)
    knots = []
    if ids and blocks > 1:
        shares = [k / ranges for k in range(1, ranges)]
        if shares:
            found = docs.agg(F.percentile_approx(number, shares, 20 * ranges)).first()[0]
            knots = [b for b in sorted(set(found)) if b > low]
    known = _block_of(number, knots, low, high, steps) if ids else F.lit(0)
    id_blocks = (len(knots) + 1) * steps
    without = F.lit(id_blocks) + F.pmod(F.xxhash64("text"), F.lit(blocks)).cast("int")
    block = F.when(F.col("doc_id").isNull(), without).otherwise(known).cast("int")
    text = F.coalesce("text", F.lit("")).alias("text")
    bins = 1 << max(0, (blocks - 1).bit_length())
    return docs.select("doc_id", text, *extra, block.alias("block")), id_blocks, bins


def bin_edges(hashes: np.ndarray, bins: int) -> np.ndarray:
    """Where each bin begins in sorted hashes; a bin is a range of values."""
    bits = bins.bit_length() - 1
    if bits == 0:
        return np.array([0, len(hashes)])
    tops = hashes >> np.uint64(64 - bits)
    return np.searchsorted(tops, np.arange(bins + 1, dtype=np.uint64))


def asked(
    block: int, hashes: np.ndarray, bins: int, dtype: type, counts: np.ndarray | None = None
) -> pa.Table:
    """The block's sorted distinct hashes, and a byte each, one cell per bin that has any."""
    edges = bin_edges(hashes, bins)
    held = np.flatnonzero(np.diff(edges))
    bits = bins.bit_length() - 1
    if dtype is np.uint32:  # what follows the bin's bits
        hashes = (hashes << np.uint64(bits)) >> np.uint64(32)
    cells = []
    for b in held:
        part = slice(edges[b], edges[b + 1])
        tail = b"" if counts is None else counts[part].tobytes()
        cells.append(pack_planes(hashes[part].astype(dtype)) + tail)
    return pa.table(
        {
            "block": pa.array([block] * len(held), pa.int32()),
            "bin": pa.array(held, pa.int32()),
            "hashes": pa.array(cells, pa.binary()),
        }
    )


def answered(
    table: pa.Table,
    dtype: type,
    judge: Callable[[np.ndarray, np.ndarray], np.ndarray],
    counted: bool = False,
) -> pa.Table:
    """Answers for one bin. ``judge`` gets equal hashes side by side, smaller blocks first,
    as (group number of each entry, its block or its count), and returns a byte for each."""
    table = table.sort_by("block")
    cells = [x.as_py() for x in table.column("hashes")]
    width = np.dtype(dtype).itemsize + counted
    sizes = [len(c) // width for c in cells]
    parts = [unpack_planes(c[: n * (width - counted)], dtype) for c, n in zip(cells, sizes)]
    if counted:
        tails = [c[n * (width - 1) :] for c, n in zip(cells, sizes)]
        beside = np.frombuffer(b"".join(tails), np.uint8)
    else:
        beside = np.repeat(table.column("block").to_numpy(), sizes)
    values = np.concatenate(parts)
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    group = np.cumsum(np.concatenate(([0], ranked[1:] != ranked[:-1])))
    answers = np.empty(len(values), np.uint8)
    answers[order] = judge(group, beside[order])
    cells = [a.tobytes() for a in np.split(answers, np.cumsum(sizes)[:-1])]
    return pa.table(
        {
            "block": table.column("block"),
            "bin": table.column("bin"),
            "answer": pa.array(cells, pa.binary()),
        }
    )


def joined_answers(table: pa.Table) -> np.ndarray:
    """A block's answers in the order of its sorted hashes."""
    table = table.sort_by("bin")
    cells = [x.as_py() for x in table.column("answer")]
    return np.frombuffer(b"".join(cells), np.uint8)


def encoded(texts: pa.ChunkedArray) -> list[bytes]:
    return [x or b"" for x in texts.cast(pa.binary()).to_pylist()]
