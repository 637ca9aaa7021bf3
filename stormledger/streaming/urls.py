"""URL dedup across runs, with the seen URLs as stream state or as a stored index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stormledger.functions.urls import url_base
from stormledger.operators.seen import SLOTS as INDEX_SLOTS
from stormledger.operators.seen import SeenUrls

SALTS = 16


def first_urls(
    stream: DataFrame,
    url: str,
    event_time: str,
    watermark: str | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """The first arriving row of each URL without its query part.

    ``event_time`` has to be a TIMESTAMP. Without a watermark a URL is remembered for
    good, so no row is late and none is lost; state then grows with the number of
    different URLs, for which the RocksDB state store is made. A watermark bounds how
    long a URL is remembered, and Spark drops rows that arrive later than it allows, also
    those of new URLs.

    Copies of a widely shared URL are first thinned under (URL, salt), which spreads
    them over tasks; at most one row per salt then meets in the second step.
    """
    based = stream.withColumns(
        {
            "url_base": url_base(F.col(url)),
            "_salt": F.pmod(F.xxhash64(url, event_time), F.lit(salts)),
        }
    )
    if watermark is None:
        thinned = based.dropDuplicates(["url_base", "_salt"])
        return thinned.dropDuplicates(["url_base"]).drop("_salt")
    bounded = based.withWatermark(event_time, watermark)
    thinned = bounded.dropDuplicatesWithinWatermark(["url_base", "_salt"])
    return thinned.dropDuplicatesWithinWatermark(["url_base"]).drop("_salt")


def start_first_urls(
    stream: DataFrame, url: str, root: str, checkpoint: str, *order: str, slots: int = INDEX_SLOTS
) -> StreamingQuery:
    """The first row of each URL, with the seen URLs in an index on disk below ``root``.

    Nothing is held as stream state, so memory stays bounded without a watermark: no row is
    late, and a new URL is kept however old its event time. A batch opens only what its URLs
    may be in. ``order`` says which row of a batch is the first. ``kept_urls`` has the rows.
    """

    def take(rows: DataFrame, batch: int) -> None:
        SeenUrls(rows.sparkSession, root, slots).add(f"batch-{batch:012d}", rows, url, *order)

    return (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def kept_urls(index: SeenUrls) -> DataFrame:
    """The rows of all committed batches of an index; there has to be one."""
    made = [r["run_id"] for r in index.table.log.records() if "rows" in r["outputs"]]
    rows = index.rows(made[0])
    for run_id in made[1:]:
        rows = rows.unionByName(index.rows(run_id))
    return rows
