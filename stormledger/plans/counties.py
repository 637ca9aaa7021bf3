"""County dimension from landed state and county payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.functions.codes import compose_geoid, fips_key, zero_pad
from stormledger.functions.text import clean_name, first_segment
from stormledger.operators.dedup import keep_first, keep_last
from stormledger.operators.joins import lookup
from stormledger.operators.numbering import index_rows
from stormledger.schemas import COUNTY
from stormledger.sinks.writers import write_csv, write_json_array
from stormledger.sources.payloads import header_row_json


def read_states(payloads: DataFrame, payload: str = "value") -> DataFrame:
    """(row_pos, state_name, state_fips) from header-row JSON."""
    rows = header_row_json(payloads, F.col(payload), ["state_name", "state"])
    return rows.select("row_pos", "state_name", zero_pad(F.col("state"), 2).alias("state_fips"))


def read_state_counties(
    payloads: DataFrame, payload: str = "value", state_fips: str = "state_fips"
) -> DataFrame:
    """County rows of one payload per state, under the state they were asked for."""
    rows = header_row_json(
        payloads, F.col(payload), ["full_label", "state", "county"], state_fips
    )
    return rows.select(
        F.col(state_fips).alias("state_fips"),
        "row_pos",
        "full_label",
        zero_pad(F.col("county"), 3).alias("county_fips"),
    )


def county_dimension(states: DataFrame, counties: DataFrame) -> DataFrame:
    """One row per county geoid, the first one in payload order.

    States without a county payload contribute no rows.
    """
    named = lookup(
        counties, states.select("state_fips", "state_name", F.col("row_pos").alias("_state")),
        ["state_fips"],
    )
    rows = named.select(
        "state_name",
        "state_fips",
        first_segment(F.col("full_label")).alias("county_name"),
        "county_fips",
        compose_geoid(F.col("state_fips"), F.col("county_fips")).alias("county_geoid"),
        clean_name(F.col("full_label")).alias("county_name_clean"),
        "_state",
        "row_pos",
    )
    return keep_first(rows, ["county_geoid"], "_state", "row_pos").select(*COUNTY.names)


def write_counties(counties: DataFrame, csv_path: str, json_path: str) -> None:
    """CSV and JSON array, sorted by state and county code."""
    indexed = index_rows(counties, ["state_fips", "county_fips", "county_geoid"], "_index")
    write_csv(counties.orderBy("state_fips", "county_fips"), csv_path)
    write_json_array(
        indexed.select("_index", *COUNTY.names), json_path, "_index"
    )


def run_counties(
    spark: SparkSession, states_path: str, counties_path: str, csv_path: str, json_path: str
) -> None:
    """County files from landed payloads.

    ``states_path`` holds the state payload; below ``counties_path`` lies one folder
    ``state_fips=NN`` per state with its county payload. A payload is one file, a few
    hundred rows long at most.
    """
    landed = spark.read.text(counties_path, wholetext=True).withColumn(
        "state_fips", zero_pad(F.col("state_fips").cast("string"), 2)
    )
    states = read_states(spark.read.text(states_path, wholetext=True))
    table = county_dimension(states, read_state_counties(landed))
    write_counties(table, csv_path, json_path)


def county_map(counties: DataFrame, position: Sequence[str] = ("file", "row_index")) -> DataFrame:
    """(county_fips, state_name, county_name_clean), unique; the last row of a key wins.

    Takes the frame of ``read_counties``. Rows whose key has no digit are left out;
    ``unkeyed_counties`` returns them.
    """
    keyed = _keyed(counties).where(F.col("_fips").isNotNull())
    return keep_last(
        keyed.select(
            F.col("_fips").alias("county_fips"), "state_name", "county_name_clean", *position
        ),
        ["county_fips"],
        *position,
    ).drop(*position)


def unkeyed_counties(counties: DataFrame) -> DataFrame:
    """County rows without a usable code, set aside for review."""
    return _keyed(counties).where(F.col("_fips").isNull()).drop("_fips")


def _keyed(counties: DataFrame) -> DataFrame:
    def column(name: str):
        return F.col(name) if name in counties.columns else None

    key = fips_key(column("county_geoid"), column("state_fips"), column("county_fips"))
    return counties.withColumn("_fips", key)
