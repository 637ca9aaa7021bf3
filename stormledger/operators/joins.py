"""Joins: lookups, the interval join, and the newest points of a window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stormledger.operators.ranking import top_n_per_group
from stormledger.storage import durable

def lookup(
    facts: DataFrame, dimension: DataFrame, keys: Sequence[str], keep_unmatched: bool = False
) -> DataFrame:
    """Attach dimension columns by equal keys; unmatched rows go or stay as NULL.

    The dimension has to be unique on ``keys``. No hint: Spark broadcasts it where its
    size is known to be below ``spark.sql.autoBroadcastJoinThreshold``, when planning
    from the size of its files or at run time, and else shuffles and splits hot keys.
    """
    how = "left" if keep_unmatched else "inner"
    return facts.join(dimension, list(keys), how)


def _bucket(instant: Column, days: int) -> Column:
    return F.floor(F.unix_date(instant.cast("date")) / F.lit(days)).cast("int")


def _mean_days(events: DataFrame, start: str, end: str) -> int:
    days = F.datediff(F.col(end).cast("date"), F.col(start).cast("date")) + 1
    return max(1, round(events.agg(F.avg(days)).first()[0] or 1))


def _spread(events: DataFrame, start: str, end: str, bucket_days: int) -> DataFrame:
    """An event for every bucket that its window touches."""
    first, last = _bucket(F.col(start), bucket_days), _bucket(F.col(end), bucket_days)
    return events.withColumn("_bucket", F.explode(F.sequence(first, last)))


def interval_join(
    events: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    at: str,
    bucket_days: int | None = None,
) -> DataFrame:
    """Pairs with equal ``keys`` and ``start <= at <= end``, both ends included.

    Events are copied into every time bucket their window touches, points fall into
    exactly one, so buckets join by equality and no pair comes up twice. A point's bucket is
    worked out from its instant where it is needed and is not sent along. Inverted
    windows match nothing. Without ``bucket_days`` a bucket is as long as the mean window,
    which is read from the events: then there are about two copies per event, however long
    the windows are. Where both sides are too large to broadcast they shuffle on
    (keys, bucket), and adaptive execution splits the partitions of a hot key.
    """
    upright = events.where(F.col(start) <= F.col(end))
    if bucket_days is None:
        bucket_days = _mean_days(upright, start, end)
    rest = [c for c in events.columns if c not in keys]
    spread = _spread(upright, start, end, bucket_days).select(*keys, *rest, "_bucket")
    theirs = {key: f"_point_{key}" for key in keys}
    pairs = spread.join(
        points.withColumnsRenamed(theirs),
        [
            *[F.col(key) == F.col(name) for key, name in theirs.items()],
            F.col("_bucket") == _bucket(F.col(at), bucket_days),
            F.col(at).between(F.col(start), F.col(end)),
        ],
    )
    return pairs.drop("_bucket", *theirs.values())


def newest_in_window(
    events: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    at: str,
    tie_break: Sequence[str],
    n: int,
    end_of_day: bool = False,
) -> DataFrame:
    """The ``n`` newest points of every event's window, ``rank`` 1 first.

    The rows are those of ``interval_join`` cut to ``n`` per event, but its pairs are
    never built. ``start`` and ``end`` are dates, so the window's edges fall between
    slots: a day's midnight is one slot, the rest of the day another. A window ends with
    the midnight that begins ``end``, or with that whole day (``end_of_day``).

    - At most ``n`` points per key and slot can be among anyone's newest ``n``.
    - Numbered per key from newest to oldest, the points of a window are a run of
      numbers, and the newest ``n`` of them are its start. Counts per slot, summed over
      the later slots of a key, give the number of points that are newer than a slot: than
      the last slot of a window, and than the last one before it.
    - Events meet blocks of ``n`` numbers by equality. A run of ``n`` touches two
      blocks at most, so an event meets no more than ``2 n`` points however many the
      key has.

    Points and edges of windows are counted together, once. The running sum goes over one row
    per key and slot, never over points or events. It is written down, and its three joins read
    the same rows, so they share one shuffle of it.
    """
    day = F.col(at).cast("date")
    after_midnight = (F.col(at) != day.cast(points.schema[at].dataType)).cast("int")
    slotted = points.withColumn("_own", 2 * F.unix_date(day) + after_midnight)
    newest_first = [F.col(at).desc(), *[F.col(c) for c in tie_break]]
    kept = top_n_per_group(slotted, [*keys, "_own"], newest_first, n, "_nth")

    # The last slot of a window, and the last one before it.
    last, earlier = 2 * F.unix_date(end) + int(end_of_day), 2 * F.unix_date(start) - 1
    edged = events.where(F.col(start) <= F.col(end)).withColumns(
        {"_last": last, "_earlier": earlier}
    )
    edges = edged.select(
        *keys, F.explode(F.array("_last", "_earlier")).alias("_slot"), F.lit(0).alias("_size")
    )
    sizes = (
        slotted.select(*keys, F.col("_own").alias("_slot"), F.lit(1).alias("_size"))
        .unionByName(edges)
        .groupBy(*keys, "_slot")
        .agg(F.least(F.sum("_size"), F.lit(n).cast("bigint")).alias("_size"))
    )
    later = W.partitionBy(*keys).orderBy(F.col("_slot").desc()).rowsBetween(W.unboundedPreceding, -1)
    newer = F.coalesce(F.sum("_size").over(later), F.lit(0))
    # The filter holds for every row. Spark adds it for some of the joins, and those without it
    # could not share a shuffle with them.
    slots = durable(sizes.select(*keys, "_slot", newer.alias("_newer"))).where("_newer IS NOT NULL")

    def newer_than(slot: str, name: str) -> DataFrame:
        return slots.select(*keys, F.col("_slot").alias(slot), F.col("_newer").alias(name))

    numbered = (
        kept.join(newer_than("_own", "_above"), [*keys, "_own"])
        .withColumn("_number", F.col("_above") + F.col("_nth") - 1)
        .withColumn("_block", F.floor(F.col("_number") / F.lit(n)))
        .drop("_own", "_nth", "_above")
    )
    runs = (
        edged.join(newer_than("_last", "_low"), [*keys, "_last"])
        .join(newer_than("_earlier", "_high"), [*keys, "_earlier"])
        .withColumn("_high", F.least(F.col("_high"), F.col("_low") + n))
        .where(F.col("_low") < F.col("_high"))
        .withColumn(
            "_block",
            F.explode(
                F.sequence(
                    F.floor(F.col("_low") / F.lit(n)), F.floor((F.col("_high") - 1) / F.lit(n))
                )
            ),
        )
    )
    met = runs.join(numbered, [*keys, "_block"]).where(
        (F.col("_number") >= F.col("_low")) & (F.col("_number") < F.col("_high"))
    )
    return met.withColumn("rank", (F.col("_number") - F.col("_low") + 1).cast("int")).drop(
        "_block", "_number", "_last", "_earlier", "_low", "_high"
    )
