"""The driver's tables in the roles of this package's inputs.

Orders stand for declarations and customers for counties. A customer in debt is not
in the county map, so that some declarations find no county. Dates, codes and types
vary with order status and priority, so that every branch of the rules is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.catalog.registry import table
from stormledger.functions.codes import compose_geoid
from stormledger.functions.dates import iso_text
from stormledger.schemas import DECLARATION

STATES = 56


def _state_code(customer: str):
    return (F.col(customer) % STATES).cast("string")


def declarations(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    day = iso_text(F.col("o_orderdate"))
    two_days_on = iso_text(F.date_add(F.col("o_orderdate").cast("date"), 2))
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.when(~((status == "P") & (priority == "5-LOW")), F.concat(day, F.lit("T00:00:00.000Z")))
            .alias("declarationDate"),
            F.when(status == "F", F.concat(day, F.lit("T23:00:00-05:00")))
            .when(status == "P", F.concat(day, F.lit(" 00:00:00")))
            .alias("incidentBeginDate"),
            F.when(status == "F", F.concat(two_days_on, F.lit("T00:00:00.000Z")))
            .alias("incidentEndDate"),
            F.when(priority == "1-URGENT", "Severe Storm(s)")
            .when(priority == "2-HIGH", " Flash Flood ")
            .when(priority == "3-MEDIUM", "Coastal Flooding")
            .when(priority == "4-NOT SPECIFIED", "Biological")
            .alias("incidentType"),
            status.alias("declarationType"),
            F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("declarationTitle"),
            F.lit(None).cast("string").alias("designatedArea"),
            F.concat(F.lit("S"), status).alias("state"),
            _state_code("o_custkey").alias("fipsStateCode"),
            F.when((priority == "4-NOT SPECIFIED") & (status == "F"), "0A1")
            .otherwise(F.col("o_custkey").cast("string"))
            .alias("fipsCountyCode"),
            F.col("o_orderkey").alias("disasterNumber"),
        )
        .select(*DECLARATION.names)
    )


def county_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .where("c_acctbal > 0")
        .select(
            compose_geoid(_state_code("c_custkey"), F.col("c_custkey").cast("string")).alias(
                "county_fips"
            ),
            F.col("c_mktsegment").alias("state_name"),
            F.col("c_name").alias("county_name_clean"),
        )
    )


# The same roles in SQL, written from the rules' meaning rather than from the code.
CLASSIFIED_SQL = """
WITH base AS (
  SELECT o_orderkey AS num, o_orderstatus AS st, o_orderpriority AS pr, o_custkey AS ck,
         CAST(o_orderdate AS DATE) AS d
  FROM orders
), derived AS (
  SELECT *,
    CASE WHEN st = 'P' AND pr = '5-LOW' THEN NULL ELSE d END AS declared,
    CASE WHEN st = 'F' THEN d END AS begin_day,
    CASE WHEN st = 'F' THEN d + 2 END AS end_day,
    pr = '4-NOT SPECIFIED' AND st = 'F' AS bad_code,
    CASE pr WHEN '1-URGENT' THEN 'Severe Storm(s)' WHEN '2-HIGH' THEN ' Flash Flood '
            WHEN '3-MEDIUM' THEN 'Coastal Flooding' WHEN '4-NOT SPECIFIED' THEN 'Biological'
            ELSE '' END AS kind,
    CASE pr WHEN '1-URGENT' THEN 'storm' WHEN '2-HIGH' THEN 'flood' WHEN '3-MEDIUM' THEN 'flood'
            WHEN '4-NOT SPECIFIED' THEN 'storm' ELSE '' END AS disaster
  FROM base
), mapped AS (
  SELECT derived.*, c_name, c_mktsegment,
    lpad(CAST(ck % 56 AS VARCHAR), 2, '0') ||
      CASE WHEN bad_code THEN '0A1'
           WHEN ck < 100 THEN lpad(CAST(ck AS VARCHAR), 3, '0')
           ELSE CAST(ck AS VARCHAR) END AS fips,
    strftime(coalesce(begin_day, declared) - INTERVAL 7 DAY, '%Y-%m-%d') AS ws,
    strftime(coalesce(end_day, declared) + INTERVAL 14 DAY, '%Y-%m-%d') AS we
  FROM derived LEFT JOIN customer ON c_custkey = ck AND c_acctbal > 0 AND NOT bad_code
), classified AS (
  SELECT *, CASE WHEN ws IS NULL OR we IS NULL THEN 'no_dates'
                 WHEN bad_code THEN 'bad_fips'
                 WHEN c_name IS NULL THEN 'fips_not_in_county_map'
                 ELSE '' END AS reason
  FROM mapped
)
"""

SPINE_SQL = (
    CLASSIFIED_SQL
    + """
SELECT c_mktsegment AS state, c_name AS county, fips AS county_fips,
  strftime(declared, '%Y-%m-%d') AS date,
  CASE WHEN st IN ('F', 'P') THEN strftime(d, '%Y-%m-%d') END AS incident_begin,
  strftime(end_day, '%Y-%m-%d') AS incident_end,
  ws AS window_start, we AS window_end, disaster,
  kind AS fema_incident_type, st AS fema_declaration_type,
  'Order ' || CAST(num AS VARCHAR) AS fema_declaration_title, '' AS fema_designated_area,
  num AS fema_disaster_number,
  c_name || ', ' || c_mktsegment || ' — ' || CASE WHEN kind = '' THEN 'Disaster' ELSE kind END
    AS label,
  'FEMA' AS source
FROM classified WHERE reason = ''
"""
)
