"""Articles as their payloads land: each payload file is taken once, each URL kept once.

A trigger's payloads meet the events of one version of the spine, fixed when it was first used.
What passes the title filter is asked of the index of all URLs that earlier triggers had
(``operators.seen``), and the rest is the trigger's run, under its batch number. Spark gives a batch
that failed the same number and the same files again, and a run that is committed is not run
again; so a restart after a crash at any place neither loses nor doubles an article. No stream
state is held.

A URL belongs to the trigger that first had it, and within a trigger to the first event in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stormledger.functions.fixed import DEFAULT_LANGUAGE, MAX_ARTICLES_PER_EVENT, MIN_TITLE_HITS
from stormledger.operators.seen import SLOTS, SeenUrls
from stormledger.plans.articles import (
    EVENT_KEY,
    LANDED_PAYLOAD,
    attach_payloads,
    first_articles,
    ordered_events,
)
from stormledger.schemas import ARTICLE
from stormledger.sinks.commits import Output, RunLog
from stormledger.sources.ndjson import CORRUPT, parse_lines
from stormledger.streaming.urls import kept_urls

ORDER = ("_order", "article_pos")


def _run_id(batch: int) -> str:
    return f"batch-{batch:012d}"


def fix_events(spark: SparkSession, spine: DataFrame, root: str, version: str) -> DataFrame:
    """The events of a version of the spine, written when the version is first named."""
    output = Output(f"{root}/events", by_run=True)

    def write(folder: dict[str, str]) -> dict:
        ordered_events(spine).write.parquet(folder["events"])
        return {}

    RunLog(spark, f"{root}/versions").run(version, {"events": output}, write)
    return spark.read.parquet(f"{root}/events/run_id={version}")


def start_article_stream(
    spark: SparkSession,
    events: DataFrame,
    payload_path: str,
    root: str,
    checkpoint: str,
    per_event: int = MAX_ARTICLES_PER_EVENT,
    min_title_hits: int = MIN_TITLE_HITS,
    language: str = DEFAULT_LANGUAGE,
    max_files: int = 1000,
    slots: int = SLOTS,
) -> StreamingQuery:
    """Take the payload files that are new, and stop. ``events`` comes from ``fix_events``."""

    def take(lines: DataFrame, batch: int) -> None:
        rows = parse_lines(lines, LANDED_PAYLOAD)
        payloads = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        offered = attach_payloads(
            events, payloads, EVENT_KEY, "_order", columns=[], first=per_event, scored=True
        )
        first = first_articles(events, offered, min_title_hits, language)
        SeenUrls(spark, root, slots).add(_run_id(batch), first, "url", *ORDER)

    return (
        spark.readStream.schema(T.StructType([T.StructField("value", T.StringType())]))
        .option("maxFilesPerTrigger", max_files)
        .text(payload_path)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def articles_so_far(spark: SparkSession, root: str) -> DataFrame:
    """The articles of all committed triggers."""
    index = SeenUrls(spark, root)
    index.table.log.finish()
    if not index.table.log.records():
        return spark.createDataFrame([], ARTICLE)
    return kept_urls(index).select(*ARTICLE.names)
