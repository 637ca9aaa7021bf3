"""Crawl manifest and ingest of the landed article payloads."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormledger.functions.dates import ymd8_to_iso
from stormledger.functions.fixed import CHUNK_SIZE, DISASTERS, QUERY_SCOPE
from stormledger.functions.search import location_clause, theme_clause
from stormledger.functions.text import safe_trim
from stormledger.functions.urls import encode_query, source_or_host
from stormledger.operators.filters import not_empty
from stormledger.operators.numbering import assign_chunks
from stormledger.operators.rollups import articles_by_date, first_by
from stormledger.schemas import PROGRESS_COLUMNS, WORK_KEY
from stormledger.sinks.writers import append_ndjson, write_audit, write_csv, write_ndjson
from stormledger.sources.ndjson import land_ndjson
from stormledger.sources.payloads import csv_payload_array, explode_structs, usable_payload
from stormledger.sources.tabular import read_counties, read_done_keys
from stormledger.storage import durable

ARTICLE_FIELDS = ("title", "url", "source")


def work_keys(counties: DataFrame, disasters: tuple[str, ...] = DISASTERS) -> DataFrame:
    """Every county once per disaster."""
    names = F.array(*[F.lit(d) for d in disasters])
    return counties.select("*", F.explode(names).alias("disaster"))


def pending_keys(keys: DataFrame, done: DataFrame) -> DataFrame:
    return keys.join(done, list(WORK_KEY), "left_anti")


def manifest(
    pending: DataFrame, seed: int, chunk_size: int = CHUNK_SIZE, max_chunks: int | None = None
) -> DataFrame:
    """Pending keys with their query, in seeded order, cut into chunks.

    The encoded query is a column for whatever makes the requests; nothing is
    requested here.
    """
    query = F.concat_ws(
        " ", theme_clause(F.col("disaster")), location_clause(F.col("county"), F.col("state"))
    )
    shuffled = [F.xxhash64(F.lit(seed), *[F.col(k) for k in WORK_KEY]), *WORK_KEY]
    return assign_chunks(
        pending.withColumn("query", query).withColumn(
            "encoded_query", encode_query(F.concat_ws(" ", "query", F.lit(QUERY_SCOPE)))
        ),
        shuffled,
        chunk_size,
        max_chunks,
    )


def payload_days(payloads: DataFrame, text: str = "csv_text") -> DataFrame:
    """Each landed CSV payload with its articles by date, in a column ``days``.

    Within one payload, the first copy of a URL stands for it even when its date is
    unusable; such a URL is then dropped. Everything happens inside the payload's row.
    """
    source_fields = ["DocumentIdentifier", "Date", "Title", "SourceCommonName"]

    def named(row: Column) -> Column:
        url = safe_trim(row["DocumentIdentifier"])
        return F.struct(
            row["article_pos"].alias("article_pos"),
            url.alias("url"),
            F.coalesce(ymd8_to_iso(row["Date"]), F.lit("")).alias("date"),
            F.coalesce(row["Title"], F.lit("")).alias("title"),
            source_or_host(row["SourceCommonName"], url).alias("source"),
        )

    rows = F.filter(
        F.transform(csv_payload_array(F.col(text), source_fields), named),
        lambda a: not_empty(a["url"]),
    )
    dated = F.filter(first_by(rows, "url"), lambda a: a["date"] != "")
    return payloads.withColumn("days", articles_by_date(dated, "date", ARTICLE_FIELDS))


def county_articles(days: DataFrame) -> DataFrame:
    """One row per payload and date, newest date first within a payload."""
    return explode_structs(days, F.col("days"), *WORK_KEY, computed=True)


def progress(days: DataFrame) -> DataFrame:
    """Date groups and articles of each payload, zeros included."""
    n = F.aggregate("days", F.lit(0).cast("bigint"), lambda a, d: a + F.size(d["articles"]))
    return days.select(
        *WORK_KEY, F.size("days").cast("bigint").alias("date_groups"), n.alias("articles")
    ).select(*PROGRESS_COLUMNS)


def accepted(text: str = "csv_text", status: str = "status") -> Column:
    """True for a payload that a fetch would have accepted."""
    return usable_payload(F.col(text), F.col(status), min_length=100)


LANDED_PAYLOAD = T.StructType(
    [
        *[T.StructField(key, T.StringType()) for key in WORK_KEY],
        T.StructField("status", T.IntegerType()),
        T.StructField("csv_text", T.StringType()),
    ]
)


def run_manifest(
    spark: SparkSession,
    counties_path: str,
    log_path: str,
    out: str,
    seed: int,
    chunk_size: int = CHUNK_SIZE,
    max_chunks: int | None = None,
) -> None:
    """Write the queries that are still to be made."""
    places = read_counties(spark, counties_path).select(
        F.col("state_name").alias("state"), F.col("county_name_clean").alias("county")
    )
    pending = pending_keys(work_keys(places), read_done_keys(spark, log_path))
    write_ndjson(manifest(pending, seed, chunk_size, max_chunks), out)


def run_ingest(
    spark: SparkSession,
    payload_path: str,
    out: str,
    log_path: str,
    bad_path: str | None = None,
    run_id: str | None = None,
) -> dict[str, int]:
    """Write the landed payloads' articles and the progress of their keys.

    Payload lines are (state, county, disaster, status, csv_text). Only keys that answered
    200 are logged; others stay pending. Malformed lines go to ``bad_path``, if given.

    With a ``run_id`` both outputs go to a folder of that run, and repeating the run
    replaces it; without one they are appended. Returns the totals.
    """
    landed, bad = land_ndjson(spark, payload_path, LANDED_PAYLOAD)
    text = F.when(accepted(), F.col("csv_text"))
    days = durable(
        payload_days(landed.where("status = 200").withColumn("csv_text", text)).drop("csv_text")
    )
    done = progress(days)
    if run_id is None:
        append_ndjson(county_articles(days), out)
        write_csv(done, log_path, mode="append")
    else:
        write_ndjson(county_articles(days), f"{out}/run_id={run_id}")
        write_csv(done, f"{log_path}/run_id={run_id}")
    malformed = bad.count()
    if bad_path is not None:
        write_audit(bad, bad_path, run_id or uuid.uuid4().hex)
    totals = done.agg(F.count("*"), F.sum("date_groups"), F.sum("articles")).first()
    names = ("payloads", "date_groups", "articles")
    return {n: v or 0 for n, v in zip(names, totals)} | {"malformed": malformed}
