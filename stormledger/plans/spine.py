"""Declarations to the county-event table ("spine") and its audit log."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.functions.categories import category_or_label, event_label, is_default_category
from stormledger.functions.codes import compose_geoid
from stormledger.functions.dates import event_window, iso_prefix, iso_text, parse_date_lenient
from stormledger.functions.fixed import PAGE_SIZE, POST_DAYS, PRE_DAYS
from stormledger.operators.filters import (
    BAD_FIPS,
    KEPT,
    NO_DATES,
    declaration_filter,
    has_declaration_date,
    has_window,
    skip_reason,
)
from stormledger.operators.joins import lookup
from stormledger.operators.ranking import page_slice
from stormledger.operators.selection import Key
from stormledger.operators.rollups import counts_by
from stormledger.plans.counties import county_map
from stormledger.schemas import SPINE, SPINE_BASIC_COLUMNS, SPINE_LOG_COLUMNS
from stormledger.sinks.commits import Output, RunLog
from stormledger.sinks.writers import write_ndjson
from stormledger.sources.tabular import read_counties

DECLARED, WINDOWED = "declared", "windowed"


def select_declarations(
    declarations: DataFrame, max_pages: int | None = None, page_size: int = PAGE_SIZE, **bounds
) -> DataFrame:
    """Declarations in date, state and type bounds; with ``max_pages``, the newest only."""
    wanted = declarations.where(
        declaration_filter(
            F.col("declarationDate"), F.col("state"), F.col("incidentType"), **bounds
        )
    )
    if max_pages is None:
        return wanted
    rest = [c for c in wanted.columns if c != "declarationDate"]
    newest = [Key("declarationDate", descending=True), *[Key(c) for c in rest]]
    return page_slice(wanted, newest, pages=max_pages, size=page_size)


def classify(
    declarations: DataFrame,
    counties: DataFrame,
    pre_days: int = PRE_DAYS,
    post_days: int = POST_DAYS,
    dated_by: str = WINDOWED,
) -> DataFrame:
    """Every declaration with its derived fields and its ``skip_reason``.

    Spine and log are both projections of this frame. Only the county map is joined,
    so the declarations are not shuffled. ``dated_by`` is the date rule: ``WINDOWED``
    for the enriched table, ``DECLARED`` for the basic one.
    """
    empty = F.lit("")
    declared = iso_prefix(F.col("declarationDate"))
    dated = declarations.select(
        "*",
        declared.alias("date"),
        parse_date_lenient(declared).alias("_declared"),
        parse_date_lenient(F.col("incidentBeginDate")).alias("_begin"),
        parse_date_lenient(F.col("incidentEndDate")).alias("_end"),
        compose_geoid(
            F.coalesce("fipsStateCode", empty), F.coalesce("fipsCountyCode", empty)
        ).alias("county_fips"),
    )
    start, end = event_window(
        F.col("_begin"), F.col("_end"), F.col("_declared"), pre_days, post_days
    )
    windowed = dated.withColumns({"_window_start": start, "_window_end": end})
    mapped = lookup(windowed, counties, ["county_fips"], keep_unmatched=True)
    is_dated = (
        has_declaration_date(F.col("date"))
        if dated_by == DECLARED
        else has_window(F.col("_window_start"), F.col("_window_end"))
    )
    incident_type = F.coalesce("incidentType", empty)
    return mapped.select(
        F.col("state").alias("state_abbr"),
        F.col("state_name"),
        F.col("county_name_clean").alias("county"),
        "county_fips",
        "date",
        iso_prefix(F.col("incidentBeginDate")).alias("incident_begin"),
        iso_prefix(F.col("incidentEndDate")).alias("incident_end"),
        iso_text(F.col("_window_start")).alias("window_start"),
        iso_text(F.col("_window_end")).alias("window_end"),
        category_or_label(F.col("incidentType")).alias("disaster"),
        incident_type.alias("fema_incident_type"),
        F.coalesce("declarationType", empty).alias("fema_declaration_type"),
        F.coalesce("declarationTitle", empty).alias("fema_declaration_title"),
        F.coalesce("designatedArea", empty).alias("fema_designated_area"),
        F.col("disasterNumber").alias("fema_disaster_number"),
        event_label(F.col("county_name_clean"), F.col("state_name"), incident_type).alias("label"),
        F.lit("FEMA").alias("source"),
        skip_reason(
            is_dated, F.col("county_fips"), F.col("state_name").isNotNull()
        ).alias("skip_reason"),
    )


def spine(classified: DataFrame) -> DataFrame:
    """The 16-column county-event table."""
    kept = classified.where(F.col("skip_reason") == KEPT)
    return kept.withColumn("state", F.col("state_name")).select(*SPINE.names)


def spine_basic(classified: DataFrame) -> DataFrame:
    """The 8-column form; classify with ``dated_by=DECLARED``."""
    return spine(classified).select(*SPINE_BASIC_COLUMNS)


def spine_log(classified: DataFrame) -> DataFrame:
    """One audit row per declaration.

    ``state`` is the full name on kept rows and the two-letter code on skipped ones;
    ``state_abbr`` always has the code. Undated rows have no category and no window,
    and a county code shows only where it was usable.
    """
    reason = F.col("skip_reason")
    empty = F.lit("")
    undated = reason == NO_DATES
    return classified.select(
        "date",
        F.when(reason == KEPT, F.col("state_name")).otherwise(F.col("state_abbr")).alias("state"),
        F.when(reason.isin(NO_DATES, BAD_FIPS), empty)
        .otherwise(F.col("county_fips"))
        .alias("county_fips"),
        F.when(reason == KEPT, F.col("county")).otherwise(empty).alias("county"),
        F.col("fema_incident_type").alias("incidentType"),
        F.when(undated, empty).otherwise(F.col("disaster")).alias("disaster"),
        F.col("fema_disaster_number").alias("disasterNumber"),
        F.when(undated, empty).otherwise(F.col("window_start")).alias("window_start"),
        F.when(undated, empty).otherwise(F.col("window_end")).alias("window_end"),
        "skip_reason",
        "state_abbr",
    ).select(*SPINE_LOG_COLUMNS, "state_abbr")


def skip_counts(classified: DataFrame) -> DataFrame:
    return counts_by(classified, "skip_reason")


def load_county_map(spark: SparkSession, counties_path: str) -> DataFrame:
    """The county map of county files; an empty one is an error, as every declaration
    would be skipped for want of its county."""
    known = county_map(read_counties(spark, counties_path))
    if known.isEmpty():
        raise ValueError(f"no county with a usable code in {counties_path}")
    return known


def run_spine(classified: DataFrame, spine_path: str, log_root: str, run_id: str) -> DataFrame:
    """Write spine and log, and return the counts by skip reason.

    The classified rows are written once, as the log run's full record; spine and counts are
    read back from it. All three outputs and the totals count together: a run that failed
    leaves no rows that readers see, and repeating a run adds nothing. Pulls with different
    ids are added to each other, also where they overlap.
    """
    spark = classified.sparkSession
    outputs = {
        "classified": Output(f"{log_root}/classified", by_run=True),
        "spine": Output(spine_path),
        "log": Output(f"{log_root}/log", by_run=True),
    }

    def write(folder: dict[str, str]) -> dict:
        classified.write.parquet(folder["classified"])
        landed = spark.read.parquet(folder["classified"])
        write_ndjson(spine(landed), folder["spine"])
        spine_log(landed).write.parquet(folder["log"])
        reasons = {r.skip_reason: r.n for r in skip_counts(landed).collect()}
        kept = F.col("skip_reason") == KEPT
        unlisted = is_default_category(F.col("fema_incident_type"))
        return {
            "declarations": sum(reasons.values()),
            "by_reason": reasons,
            "default_category": landed.where(kept & unlisted).count(),
        }

    RunLog(spark, f"{log_root}/runs").run(run_id, outputs, write)
    return skip_counts(spark.read.parquet(f"{log_root}/classified/run_id={quote(run_id, safe='')}"))
