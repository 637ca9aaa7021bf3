"""Grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.catalog.registry import query, table
from stormledger.catalog.stand_ins import CLASSIFIED_SQL, county_map, declarations
from stormledger.operators import rollups
from stormledger.plans import spine as spine_plan


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", F.col("ts").cast("date").alias("date")
    )


@query(
    """SELECT user_id, batch, date, count(*) AS n,
              string_agg(CAST(event_id AS VARCHAR) || ':' || event_type, ',' ORDER BY event_id)
              AS articles, row_number() OVER (
                PARTITION BY user_id, batch ORDER BY date DESC) - 1 AS place
       FROM (SELECT *, CAST(ts AS DATE) AS date, event_id // 1000 AS batch FROM events)
       GROUP BY user_id, batch, date"""
)
def articles_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events among a thousand make a payload, grouped inside its row."""
    batch = F.floor(F.col("event_id") / 1000).alias("batch")
    entry = F.struct("event_id", "event_type", "date")
    payloads = (
        _dated(spark, sf_dir)
        .groupBy("user_id", batch)
        .agg(F.collect_list(entry).alias("rows"))
        .select(
            "user_id",
            "batch",
            rollups.articles_by_date(
                F.col("rows"), "date", ["event_id", "event_type"], "event_id"
            ).alias("days"),
        )
    )
    shown = F.transform(
        "d.articles", lambda a: F.concat(a["event_id"].cast("string"), F.lit(":"), a["event_type"])
    )
    return payloads.select("user_id", "batch", F.posexplode("days").alias("place", "d")).select(
        "user_id",
        "batch",
        "d.date",
        F.size("d.articles").cast("bigint").alias("n"),
        F.array_join(shown, ",").alias("articles"),
        F.col("place").cast("bigint").alias("place"),
    )


@query(
    """SELECT c_custkey AS user_id, count(DISTINCT CAST(ts AS DATE)) AS date_groups,
              count(event_id) AS articles
       FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY c_custkey"""
)
def progress_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return rollups.progress_rollup(keys, _dated(spark, sf_dir), ["user_id"], "date")


@query(CLASSIFIED_SQL + "SELECT reason AS skip_reason, count(*) AS n FROM classified GROUP BY ALL")
def skip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spine_plan.skip_counts(
        spine_plan.classify(declarations(spark, sf_dir), county_map(spark, sf_dir))
    )


@query(
    """SELECT count(*) AS rows_processed, count(*) FILTER (event_type = 'purchase') AS purchases,
              count(*) FILTER (value > 10) AS valuable FROM events"""
)
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.run_totals(
        table(spark, sf_dir, "events"),
        purchases=F.col("event_type") == "purchase",
        valuable=F.col("value") > 10,
    )
