"""Structured Streaming jobs, run to the end of the files that are there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.catalog.files import page_lines
from stormledger.catalog.registry import query, table
from stormledger.catalog.stand_ins import SPINE_SQL, county_map, declarations
from stormledger.functions.urls import url_base
from stormledger.operators.seen import SeenUrls
from stormledger.plans import spine as spine_plan
from stormledger.storage import scratch_path
from stormledger.streaming.spine import start_classified_stream, stream_declaration_pages
from stormledger.streaming.urls import first_urls, kept_urls, start_first_urls


@query(SPINE_SQL)
def stream_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed page files in, county events out; the second start finds nothing new."""
    root = scratch_path(spark, "stream-spine")
    page_lines(declarations(spark, sf_dir), "disasterNumber").write.text(f"{root}/pages")
    for _ in range(2):
        stream = stream_declaration_pages(spark, f"{root}/pages", multi_line=False)
        start_classified_stream(
            stream, county_map(spark, sf_dir), f"{root}/out", f"{root}/checkpoint"
        ).awaitTermination()
    return spine_plan.spine(spark.read.parquet(f"{root}/out"))


def _linked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(
        F.lit("http://h/"),
        F.col("user_id").cast("string"),
        F.lit("?e="),
        F.col("event_id").cast("string"),
    )
    return (
        spark.readStream.schema(table(spark, sf_dir, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
        .select(url.alias("url"), F.col("ts").cast("timestamp").alias("seen"))
    )


DISTINCT_URLS_SQL = "SELECT DISTINCT 'http://h/' || CAST(user_id AS VARCHAR) AS url_base FROM events"


@query(DISTINCT_URLS_SQL)
def stream_url_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-urls")
    (
        first_urls(_linked_events(spark, sf_dir), "url", "seen")
        .select("url_base")
        .writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{root}/out")


@query(DISTINCT_URLS_SQL)
def stream_url_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the seen URLs in an index on disk instead of stream state."""
    root = scratch_path(spark, "stream-url-index")
    for _ in range(2):  # the second start finds nothing new
        start_first_urls(
            _linked_events(spark, sf_dir), "url", f"{root}/seen", f"{root}/checkpoint", "seen", slots=4
        ).awaitTermination()
    kept = kept_urls(SeenUrls(spark, f"{root}/seen"))
    return kept.select(url_base(F.col("url")).alias("url_base"))
