"""Distributed least-significant-digit radix sort: the place of every row in key order.

Rows carry their position. One pass takes one digit of the key and is a counting sort:

1. rows are counted per (chunk of positions, digit),
2. prefix sums over these counts, digit by digit and within a digit chunk by chunk, give each
   (chunk, digit) the first of its destinations,
3. a row's destination is that number plus the rows of its chunk and digit that stand before it.

As the order within a digit is that of the pass before (stable), rows are in key order after
the last digit. The rows themselves move once per pass. A task gets whole (chunk, digit) groups
of at most ``2 ** CHUNK_BITS`` rows, however often a key repeats; a digit's counts, one per chunk,
are summed in one task, and only the sums per digit, at most ``2 ** DIGIT_BITS``, meet in one place.
Each pass is a table in the shared folder, so a lost executor costs its part of one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormledger.storage import durable

CHUNK_BITS = 13
DIGIT_BITS = 9
_LEAST = -(1 << 63)


def digits(key: str, low: int, high: int) -> list[Column]:
    """The digits of a whole-number key within its range, least significant first."""
    bits = (high - low).bit_length()
    if not bits:
        return []
    # a range that no long can hold: flipping the sign bit makes the order that of unsigned numbers
    value = F.col(key) - F.lit(low) if bits < 64 else F.col(key).bitwiseXOR(F.lit(_LEAST))
    passes = -(-bits // DIGIT_BITS)
    width = -(-bits // passes)
    return [
        F.shiftrightunsigned(value, width * i).bitwiseAND(F.lit((1 << width) - 1))
        for i in range(passes)
    ]


def counting_pass(rows: DataFrame, digit: Column) -> DataFrame:
    """The rows (columns ``position`` and others) with their positions after this digit."""
    kept = rows.columns
    placed = rows.withColumn("digit", digit).withColumn(
        "chunk", F.shiftright("position", CHUNK_BITS)
    )
    counts = placed.groupBy("chunk", "digit").agg(F.count("*").alias("n"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.groupBy("digit").agg(F.sum("n").alias("n"))
    first = sums.select("digit", F.sum("n").over(before.orderBy("digit")).alias("first"))
    within = F.sum("n").over(before.partitionBy("digit").orderBy("chunk"))
    offsets = (
        counts.select("chunk", "digit", within.alias("earlier"))
        .join(F.broadcast(first), "digit")
        .select(
            "chunk",
            "digit",
            (F.coalesce("first", F.lit(0)) + F.coalesce("earlier", F.lit(0))).alias("offset"),
        )
    )
    local = F.row_number().over(Window.partitionBy("chunk", "digit").orderBy("position"))
    moved = (F.col("offset") + F.col("local") - 1).cast("bigint").alias("position")
    return (
        placed.withColumn("local", local)
        .join(offsets, ["chunk", "digit"])
        .select(*[moved if c == "position" else c for c in kept])
    )


def positions(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with ``position``, from 0 in ascending order of the keys (bigint, no nulls).

    The names position, digit, chunk, local, offset, n, first and earlier must be free. Rows
    alike in all keys take their positions in any order. An empty table stays empty.
    """
    rows = durable(rows.withColumn("position", F.monotonically_increasing_id()))
    ends = [f(k).alias(f"{n}_{i}") for i, k in enumerate(keys) for n, f in _ENDS.items()]
    seen = rows.agg(*ends).first()
    if seen[0] is None:
        return rows
    steps = [
        digit
        for i, key in reversed(list(enumerate(keys)))
        for digit in digits(key, seen[f"low_{i}"], seen[f"high_{i}"])
    ]
    # without any digit to sort by, one pass over a constant still makes positions gapless
    for digit in steps or [F.lit(0).cast("bigint")]:
        rows = durable(counting_pass(rows, digit))
    return rows


_ENDS = {"low": F.min, "high": F.max}
