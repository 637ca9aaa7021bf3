"""Projections and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.catalog.registry import query, table
from stormledger.catalog.stand_ins import (
    CLASSIFIED_SQL,
    SPINE_SQL,
    county_map,
    declarations,
)
from stormledger.functions import categories, codes, dates, keys, search, text, urls
from stormledger.operators import filters
from stormledger.operators.numbering import index_rows
from stormledger.plans import spine as spine_plan

def event_url() -> Column:
    """URL of a line item taken as an article; its part and host repeat, its order does not."""
    return F.concat(
        F.lit("https://news"),
        (F.col("l_suppkey") % 7).cast("string"),
        F.lit(".example.org/"),
        F.col("l_partkey").cast("string"),
        F.lit("?from="),
        F.col("l_orderkey").cast("string"),
    )


EVENT_URL_SQL = (
    "'https://news' || CAST(l_suppkey % 7 AS VARCHAR) || '.example.org/' ||"
    " CAST(l_partkey AS VARCHAR) || '?from=' || CAST(l_orderkey AS VARCHAR)"
)


@query("SELECT p_partkey, p_name AS segment FROM part")
def first_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat(F.lit("\t "), F.col("p_name"), F.lit(" , "), F.col("p_type"), F.lit(", x"))
    return table(spark, sf_dir, "part").select("p_partkey", text.first_segment(label).alias("segment"))


@query(
    r"""SELECT p_partkey,
          trim(regexp_replace(regexp_replace(p_name || ' x',
            '\b(?:ring|widget|small|hot)\b', '', 'gi'), '\s{2,}', ' ', 'g')) AS words_removed,
          CASE p_type WHEN 'ECONOMY' THEN p_name WHEN 'SMALL' THEN p_name || ' and'
                      WHEN 'LARGE' THEN 'of ' || p_name ELSE p_name || 'city' END AS cleaned
        FROM part"""
)
def clean_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, name = F.col("p_type"), F.col("p_name")
    label = F.concat(
        F.when(kind == "ECONOMY", F.concat(name, F.lit(" COUNTY")))
        .when(kind == "SMALL", F.concat(name, F.lit(" City and Borough")))
        .when(kind == "LARGE", F.concat(F.lit("District  of  "), name))
        .otherwise(F.concat(name, F.lit("city census area"))),
        F.lit(" , Somewhere"),
    )
    with_tail = F.concat(name, F.lit(" x"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.remove_words(with_tail, ("ring", "widget", "small", "hot")).alias("words_removed"),
        text.clean_name(label).alias("cleaned"),
    )


WHITESPACE_SQL = " || ".join(f"chr({ord(c)})" for c in text.WHITESPACE)


@query(f"SELECT doc_id, trim(text, {WHITESPACE_SQL}) AS trimmed, '' AS nothing FROM documents")
def safe_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit(" \t\u2003 "), F.col("text"), F.lit("\r\n\u3000"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.safe_trim(padded).alias("trimmed"),
        text.safe_trim(F.lit(None).cast("string")).alias("nothing"),
    )


@query(
    """SELECT c_custkey,
         CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 3
              THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0')
              ELSE CAST(c_custkey AS VARCHAR) END AS padded FROM customer"""
)
def zero_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", codes.zero_pad(F.col("c_custkey").cast("string"), 3).alias("padded")
    )


@query(
    """SELECT c_custkey,
         CASE c_mktsegment WHEN 'MACHINERY' THEN NULL
           WHEN 'FURNITURE' THEN lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '007'
           ELSE repeat('0', greatest(0, 5 - length(CAST(c_custkey AS VARCHAR)))) ||
                CAST(c_custkey AS VARCHAR) END AS key
       FROM customer"""
)
def fips_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment, number = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    geoid = (
        F.when(segment == "BUILDING", F.concat(F.lit("US"), number))
        .when(segment == "MACHINERY", F.lit("none"))
        .when(segment == "FURNITURE", F.lit(""))
        .otherwise(number)
    )
    state = F.concat(F.lit("S"), F.col("c_nationkey").cast("string"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", codes.fips_key(geoid, state, F.lit("7")).alias("key")
    )


@query(
    """SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') ||
         CASE WHEN c_custkey < 100 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0')
              ELSE CAST(c_custkey AS VARCHAR) END AS geoid FROM customer"""
)
def compose_geoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        codes.compose_geoid(
            F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string")
        ).alias("geoid"),
    )


def _written_date():
    """Order dates in five layouts, two of which do not parse."""
    day, priority = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority")
    return (
        F.when(priority == "1-URGENT", F.concat(day, F.lit("T00:00:00.000Z")))
        .when(priority == "2-HIGH", F.concat(F.lit(" "), day, F.lit("\n")))
        .when(priority == "3-MEDIUM", F.concat(day, F.lit(" 00:00:00")))
        .when(priority == "4-NOT SPECIFIED", F.concat(day, F.lit("T23:00:00-05:00")))
        .otherwise(F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("-31")))
    )


@query(
    """SELECT o_orderkey, CASE o_orderpriority
           WHEN '2-HIGH' THEN ' ' || strftime(o_orderdate, '%Y-%m-') ||
                substr(strftime(o_orderdate, '%d'), 1, 1)
           WHEN '5-LOW' THEN strftime(o_orderdate, '%Y-%m') || '-31'
           ELSE strftime(o_orderdate, '%Y-%m-%d') END AS prefix
       FROM orders"""
)
def iso_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.iso_prefix(_written_date()).alias("prefix")
    )


@query(
    """SELECT o_orderkey, CASE o_orderpriority
           WHEN '3-MEDIUM' THEN NULL
           WHEN '5-LOW' THEN TRY_CAST(strftime(o_orderdate, '%Y-%m') || '-31' AS DATE)
           ELSE CAST(o_orderdate AS DATE) END AS parsed
       FROM orders"""
)
def parse_date_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.parse_date_lenient(_written_date()).alias("parsed")
    )


@query(
    """SELECT o_orderkey,
         CAST((CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 3
                    ELSE CAST(o_orderdate AS DATE) END) - INTERVAL 7 DAY AS DATE) AS window_start,
         CAST((CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE) - 30
                    ELSE CAST(o_orderdate AS DATE) END) + INTERVAL 14 DAY AS DATE) AS window_end
       FROM orders"""
)
def event_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, status = F.col("o_orderdate").cast("date"), F.col("o_orderstatus")
    start, end = dates.event_window(
        F.when(status == "F", F.date_add(day, 3)), F.when(status == "O", F.date_sub(day, 30)), day
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", start.alias("window_start"), end.alias("window_end")
    )


INCIDENT_LABELS = {
    "ECONOMY": "  SEVERE Storm(s) ",
    "MEDIUM": "Firestorm",
    "LARGE": "Tropical Cyclone",
    "STANDARD": "Coastal Flooding near a fire",
    "PROMO": "Biological",
    "SMALL": "",
}


@query(
    """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'storm' WHEN 'MEDIUM' THEN 'storm'
         WHEN 'LARGE' THEN 'hurricane' WHEN 'STANDARD' THEN 'flood' WHEN 'PROMO' THEN 'storm'
         ELSE '' END AS category,
         CASE WHEN contains(p_name, 'ring') THEN 'jewel' WHEN contains(p_name, 'old') THEN 'dated'
              ELSE 'plain' END AS custom,
         p_type = 'PROMO' AS by_default
       FROM part"""
)
def normalize_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.lit(False), "")
    for part_type, written in INCIDENT_LABELS.items():
        label = label.when(F.col("p_type") == part_type, written)
    custom = categories.normalize_category(
        F.upper("p_name"), {}, (("ring", "jewel"), ("old", "dated")), default="plain"
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        categories.category_or_label(label).alias("category"),
        custom.alias("custom"),
        F.coalesce(categories.is_default_category(label), F.lit(False)).alias("by_default"),
    )


@query(
    """SELECT c_custkey, c_name || ', ' || c_mktsegment || ' — ' ||
         CASE WHEN c_acctbal > 0 THEN 'Flood' ELSE 'Disaster' END AS label FROM customer"""
)
def event_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("c_acctbal") > 0, "Flood").otherwise("")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        categories.event_label(F.col("c_name"), F.col("c_mktsegment"), kind).alias("label"),
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN ''
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso FROM orders"""
)
def ymd8_to_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = F.date_format("o_orderdate", "yyyyMMdd")
    written = (
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit(" "), layout))
        .when(F.col("o_orderstatus") == "F", layout)
        .otherwise(F.concat(layout, F.lit("T101530Z")))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.ymd8_to_iso(written).alias("iso")
    )


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') || '000000' AS stamp FROM orders")
def compact_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = dates.iso_text(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.compact_ts(iso).alias("stamp"))


@query(
    """SELECT page_id, CASE WHEN contains(url, '#') THEN 'named'
         ELSE regexp_extract(url, 'https?://([^/]+)', 1) END AS source FROM pages"""
)
def source_or_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.when(F.contains("url", F.lit("#")), "named").otherwise("")
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.source_or_host(named, F.col("url")).alias("source")
    )


@query("SELECT page_id, split_part(url, '?', 1) AS base FROM pages")
def url_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.url_base(F.col("url")).alias("base"))


@query(
    """SELECT page_id, replace(replace(url_encode('~* ' || url || ' end'), '%20', '+'), '*', '%2A')
         AS encoded FROM pages"""
)
def encode_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.concat(F.lit(" ~* "), F.col("url"), F.lit(" end\n"))
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.encode_query(written).alias("encoded")
    )


@query(
    """SELECT page_id, CASE WHEN contains(url, '?') THEN url WHEN contains(url, '#')
         THEN 'html' ELSE '' END AS chosen FROM pages"""
)
def field_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    first = F.when(url.contains("?"), url).otherwise("")
    second = F.when(url.contains("#"), "html")
    return table(spark, sf_dir, "pages").select(
        "page_id", text.field_fallback(first, second).alias("chosen")
    )


EVENT_DISASTER_SQL = """CASE event_type WHEN 'view' THEN 'hurricane' WHEN 'click' THEN 'flood'
  WHEN 'error' THEN 'wildfire' WHEN 'purchase' THEN 'Tornado' ELSE event_type END"""


def _event_disaster():
    kind = F.col("event_type")
    return (
        F.when(kind == "view", "hurricane")
        .when(kind == "click", "flood")
        .when(kind == "error", "wildfire")
        .when(kind == "purchase", "Tornado")
        .otherwise(kind)
    )


@query(
    f"""SELECT event_id, CASE {EVENT_DISASTER_SQL}
          WHEN 'hurricane' THEN '(theme:HURRICANE OR theme:TROPICAL_CYCLONE OR theme:TYPHOON)'
          WHEN 'flood' THEN '(theme:NATURAL_DISASTER_FLOOD OR theme:FLOOD)'
          WHEN 'wildfire' THEN '(theme:WILDFIRE OR theme:FIRE_WILDFIRE)'
          ELSE {EVENT_DISASTER_SQL} END AS clause
        FROM events"""
)
def theme_clause(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", search.theme_clause(_event_disaster()).alias("clause")
    )


@query(
    """SELECT c_custkey, 'location:"' || c_name || CASE c_mktsegment
           WHEN 'MACHINERY' THEN ' Parish' WHEN 'BUILDING' THEN ' City'
           WHEN 'FURNITURE' THEN ' COUNTY' WHEN 'AUTOMOBILE' THEN '' ELSE ' County' END ||
         ', ' || CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'District of Columbia' ELSE 'Texas' END ||
         ', US"' AS clause FROM customer"""
)
def location_clause(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    suffix = (
        F.when(segment == "MACHINERY", " Parish")
        .when(segment == "BUILDING", " City")
        .when(segment == "FURNITURE", " COUNTY ")
        .otherwise("")
    )
    state = F.when(segment == "AUTOMOBILE", "District of Columbia").otherwise("Texas")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        search.location_clause(F.concat(F.col("c_name"), suffix), state).alias("clause"),
    )


def _segment_type():
    segment = F.col("c_mktsegment")
    return (
        F.when(segment == "MACHINERY", "Storm")
        .when(segment == "BUILDING", "drought")
        .otherwise(segment)
    )


def _customer_query():
    place = search.place_phrase(F.col("c_name"), F.col("c_mktsegment"))
    area = F.when(F.col("c_acctbal") > 5000, F.concat(F.col("c_name"), F.lit(' "(County)'))).otherwise("")
    return search.synonym_query(place, area, _segment_type())


CUSTOMER_QUERY_SQL = """'("' || c_name || ' County, ' || c_mktsegment || '"' ||
  CASE WHEN c_acctbal > 5000 THEN ' OR "' || c_name || ' (County)"' ELSE '' END || ') AND (' ||
  CASE c_mktsegment WHEN 'MACHINERY' THEN '"storm" OR "severe storm" OR "thunderstorm" OR "windstorm"'
    WHEN 'BUILDING' THEN '"drought"' ELSE '"' || lower(c_mktsegment) || '"' END || ')'"""


def keyword_list_sql(query_text: str) -> str:
    bare = query_text
    for dropped in ("(", ")", "AND", "OR"):
        bare = f"replace({bare}, '{dropped}', '')"
    words = f"list_transform(string_split_regex({bare}, '\\s+'), lambda w: trim(w, '\"'))"
    return f"list_distinct(list_transform(list_filter({words}, lambda w: length(w) > 2), lambda w: lower(w)))"


@query(f"SELECT c_custkey, {CUSTOMER_QUERY_SQL} AS query FROM customer")
def synonym_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", _customer_query().alias("query"))


@query(
    "SELECT c_custkey, array_to_string(list_sort("
    + keyword_list_sql(f"({CUSTOMER_QUERY_SQL})")
    + "), '|') AS keywords FROM customer"
)
def keyword_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    keywords = search.keyword_set(_customer_query())
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.array_join(F.array_sort(keywords), "|").alias("keywords")
    )


SEARCHED = ("the", "and", "que", "tion", "zzz")
HITS_SQL = " + ".join(f"CAST(contains(lower(text), '{w}') AS INT)" for w in SEARCHED)


def _hits():
    return search.title_hits(F.array(*[F.lit(w) for w in SEARCHED]), F.col("text"))


@query(f"SELECT doc_id, CAST({HITS_SQL} AS BIGINT) AS score FROM documents")
def title_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", _hits().cast("bigint").alias("score"))


@query(f"SELECT doc_id, CAST({HITS_SQL} AS BIGINT) AS score FROM documents WHERE {HITS_SQL} >= 3")
def min_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = title_hits(spark, sf_dir)
    return scored.where(filters.enough_hits(F.col("score"), 3))


@query(
    f"""SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) || '_' ||
          CASE WHEN l_suppkey < 10000 THEN lpad(CAST(l_suppkey AS VARCHAR), 5, '0')
               ELSE CAST(l_suppkey AS VARCHAR) END || '_' ||
          substr(sha1({EVENT_URL_SQL}), 1, 10) AS key
        FROM lineitem"""
)
def row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    fips = codes.zero_pad(F.col("l_suppkey").cast("string"), 5)
    url = F.concat(F.lit(" "), event_url(), F.lit("\n"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", keys.row_key(F.col("l_orderkey"), fips, url).alias("key")
    )


@query(
    """SELECT page_id, CASE WHEN contains(url, '#') THEN 'missingpk_csv_' ||
           CAST(row_number() OVER (ORDER BY page_id) - 1 AS VARCHAR)
         ELSE CAST(page_id AS VARCHAR) || '_01001_' || substr(sha1(url), 1, 10) END AS key,
         CASE WHEN contains(url, '#') THEN 'url' END AS missing
       FROM pages"""
)
def row_key_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = index_rows(
        table(spark, sf_dir, "pages").select(
            "page_id", F.when(F.col("url").contains("#"), " ").otherwise(F.col("url")).alias("url")
        ),
        ["page_id"],
    )
    parts = (F.col("page_id"), F.lit("01001"), F.col("url"), "csv", F.col("row_index"))
    return pages.select(
        "page_id",
        keys.row_key_or_fallback(*parts).alias("key"),
        keys.missing_parts(*parts[:3]).alias("missing"),
    )


@query(
    """SELECT o_orderkey AS number FROM orders
       WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1999-09-30'
         AND o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '3-MEDIUM')"""
)
def declaration_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    wanted = filters.declaration_filter(
        F.col("o_orderdate"),
        F.col("o_orderstatus"),
        F.col("o_orderpriority"),
        start="1996-03-01",
        end="1999-09-30",
        state_code="f",
        types="1-URGENT, 3-MEDIUM,",
    )
    return orders.where(wanted).select(F.col("o_orderkey").alias("number"))


@query(
    """SELECT o_orderkey, NOT (o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F') AS valid
       FROM orders"""
)
def valid_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declarations(spark, sf_dir).select(
        F.col("disasterNumber").alias("o_orderkey"),
        codes.valid_code(
            codes.compose_geoid(F.col("fipsStateCode"), F.col("fipsCountyCode"))
        ).alias("valid"),
    )


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O' AND o_orderpriority <> '5-LOW'")
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    present = filters.required_fields(
        F.when(status != "O", status), F.when(priority == "5-LOW", " \t").otherwise(priority)
    )
    return table(spark, sf_dir, "orders").where(present).select("o_orderkey")


@query(
    """SELECT page_id FROM pages WHERE NOT contains(url, '#') AND NOT contains(url, '?')
       AND NOT contains(url, 'spam')"""
)
def drop_unusable(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    title = F.when(~url.contains("#"), "title")
    link = F.when(url.contains("?"), "").otherwise(url)
    date = dates.ymd8_to_iso(F.when(url.contains("spam"), "unknown").otherwise("20240110"))
    return (
        table(spark, sf_dir, "pages").where(filters.not_empty(title, link, date)).select("page_id")
    )


@query(
    CLASSIFIED_SQL
    + """SELECT num AS o_orderkey, declared IS NOT NULL AS basic,
                ws IS NOT NULL AND we IS NOT NULL AS enriched FROM classified"""
)
def date_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = dates.iso_prefix(F.col("declarationDate"))
    start, end = dates.event_window(
        dates.parse_date_lenient(F.col("incidentBeginDate")),
        dates.parse_date_lenient(F.col("incidentEndDate")),
        dates.parse_date_lenient(declared),
    )
    return declarations(spark, sf_dir).select(
        F.col("disasterNumber").alias("o_orderkey"),
        filters.has_declaration_date(declared).alias("basic"),
        filters.has_window(start, end).alias("enriched"),
    )


@query(CLASSIFIED_SQL + "SELECT num AS o_orderkey, reason FROM classified")
def skip_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = spine_plan.classify(declarations(spark, sf_dir), county_map(spark, sf_dir))
    return classified.select(
        F.col("fema_disaster_number").alias("o_orderkey"), F.col("skip_reason").alias("reason")
    )
