"""Table layouts. Codes stay strings: inference would drop their leading zeros."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# The field names of landed files and of the tables written.

DECLARATION = T.StructType(
    _strings(
        "declarationDate",
        "incidentBeginDate",
        "incidentEndDate",
        "incidentType",
        "declarationType",
        "declarationTitle",
        "designatedArea",
        "state",
        "fipsStateCode",
        "fipsCountyCode",
    )
    + [T.StructField("disasterNumber", T.LongType())]
)
DECLARATION_ARRAY = "DisasterDeclarationsSummaries"
DECLARATION_PAGE = T.StructType([T.StructField(DECLARATION_ARRAY, T.ArrayType(DECLARATION))])

COUNTY = T.StructType(
    _strings(
        "state_name",
        "state_fips",
        "county_name",
        "county_fips",
        "county_geoid",
        "county_name_clean",
    )
)

SPINE = T.StructType(
    _strings(
        "state",
        "county",
        "county_fips",
        "date",
        "incident_begin",
        "incident_end",
        "window_start",
        "window_end",
        "disaster",
        "fema_incident_type",
        "fema_declaration_type",
        "fema_declaration_title",
        "fema_designated_area",
    )
    + [T.StructField("fema_disaster_number", T.LongType())]
    + _strings("label", "source")
)
SPINE_BASIC_COLUMNS = (
    "state",
    "county",
    "county_fips",
    "date",
    "disaster",
    "fema_incident_type",
    "fema_disaster_number",
    "source",
)
SPINE_LOG_COLUMNS = (
    "date",
    "state",
    "county_fips",
    "county",
    "incidentType",
    "disaster",
    "disasterNumber",
    "window_start",
    "window_end",
    "skip_reason",
)

PAYLOAD_ARTICLE = T.StructType(
    _strings(
        "title", "url", "seendateurl", "seendate", "date", "sourcecountry", "domain", "language"
    )
)
ARTICLE_PAYLOAD = T.StructType(
    [
        T.StructField("articles", T.ArrayType(PAYLOAD_ARTICLE)),
        T.StructField("timeline", T.ArrayType(PAYLOAD_ARTICLE)),
    ]
)

ARTICLE = T.StructType(
    [T.StructField("disasterNumber", T.LongType())]
    + _strings(
        "county_fips",
        "state",
        "county",
        "incidentType",
        "window_start",
        "window_end",
        "title",
        "url",
        "datetime",
        "sourceCountry",
        "domain",
        "lang",
    )
    + [T.StructField("score", T.LongType())]
    + _strings("kept_reason", "label", "gdelt_query")
)
ARTICLE_CSV_COLUMNS = tuple(n for n in ARTICLE.names if n not in ("label", "gdelt_query"))
ROW_KEY_COLUMN = "unique_entity_identifier"

PROGRESS_COLUMNS = ("state", "county", "disaster", "date_groups", "articles")
WORK_KEY = ("state", "county", "disaster")

# Accepted header spellings, first one present in the file's header wins.
STATE_ALIASES = ("state_name", "state")
COUNTY_ALIASES = ("county_name_clean", "countyclean", "county")
