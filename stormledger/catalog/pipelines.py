"""Whole jobs over the driver's tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.catalog.expressions import keyword_list_sql
from stormledger.catalog.files import DISASTER_OF_PRIORITY_SQL, disaster_of_priority
from stormledger.catalog.registry import query, table
from stormledger.catalog.stand_ins import CLASSIFIED_SQL, SPINE_SQL, county_map, declarations
from stormledger.functions.codes import zero_pad
from stormledger.functions.dates import compact_ts, iso_text
from stormledger.functions.fixed import TYPE_SYNONYMS
from stormledger.functions.keys import row_key
from stormledger.operators.unique import told_apart
from stormledger.plans import articles as article_plan
from stormledger.plans import counties as county_plan
from stormledger.plans import crawl as crawl_plan
from stormledger.plans import keys as key_plan
from stormledger.plans import spine as spine_plan
from stormledger.schemas import ARTICLE, ARTICLE_CSV_COLUMNS, ROW_KEY_COLUMN, SPINE
from stormledger.sinks.writers import append_lines, append_ndjson, write_articles, write_csv
from stormledger.sources.ndjson import read_ndjson
from stormledger.sources.tabular import read_csv
from stormledger.storage import scratch_path
from stormledger.streaming.articles import articles_so_far, fix_events, start_article_stream


@query(SPINE_SQL)
def enriched_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: declarations to the county-event table."""
    return spine_plan.spine(
        spine_plan.classify(declarations(spark, sf_dir), county_map(spark, sf_dir))
    )


TITLES = ("Storm and flooding near the COUNTY, again", "flood", "Weather report")
PER_PAYLOAD = 40

_SYNONYM_CASES = " ".join(
    f"""WHEN '{kind}' THEN '{" OR ".join(f'"{w}"' for w in words)}'"""
    for kind, words in TYPE_SYNONYMS.items()
)
_QUERY_SQL = (
    """'("' || county || ' County, ' || state || '") AND (' || CASE disaster """
    + _SYNONYM_CASES
    + """ END || ')'"""
)

EVENT_ARTICLES_SQL = f"""
WITH spine AS ({SPINE_SQL}),
events AS (
  SELECT *, {_QUERY_SQL} AS query FROM spine WHERE disaster <> ''
), scored AS (
  SELECT *, len(list_filter({keyword_list_sql("query")}, lambda k: contains(lower(title), k))) AS score
  FROM (
    SELECT events.*, pos, CASE pos % 3 WHEN 0 THEN '{TITLES[0]}' WHEN 1 THEN '{TITLES[1]}'
        ELSE '{TITLES[2]}' END AS title,
      'http://h/' || CAST((fema_disaster_number * 7 + pos * 13) % 4001 AS VARCHAR) || '?' ||
        CAST(pos AS VARCHAR) AS url
    FROM events, range({PER_PAYLOAD}) r(pos) WHERE pos < 30
  )
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY split_part(url, '?', 1)
    ORDER BY date DESC NULLS LAST, fema_disaster_number, county_fips, pos) AS copy
  FROM scored WHERE score >= 1
)
SELECT CAST(fema_disaster_number AS VARCHAR) || '_' || county_fips || '_' ||
         substr(sha1(url), 1, 10) AS unique_entity_identifier,
  fema_disaster_number AS "disasterNumber", county_fips, disaster AS "incidentType",
  window_start, window_end, title, url, 'day ' || CAST(pos AS VARCHAR) AS datetime,
  'English' AS lang, score, 'title_hits>=1' AS kept_reason, trim(label) AS label, query AS gdelt_query
FROM ranked WHERE copy = 1
"""


#: Lines of a gzipped file: of the spine, and of payloads.
SPINE_LINES, PAYLOAD_LINES = 25_000, 50_000


def _landed_payloads(events: DataFrame) -> DataFrame:
    """A payload, as a line of JSON, for each row of (disasterNumber, county_fips).

    Lines are put together from texts: what differs between articles is a number.
    """
    number = F.col("disasterNumber")
    cut = "\0"  # where the page of a URL goes

    def article(i: int) -> str:
        record = {
            "title": TITLES[i % 3],
            "url": f"http://h/{cut}?{i}",
            "seendateurl": "",
            "seendate": f"day {i}",
            "date": None,
            "sourcecountry": None,
            "domain": "",
            "language": "",
        }
        return json.dumps(record, separators=(",", ":"))

    texts = ",".join(map(article, range(PER_PAYLOAD))).split(json.dumps(cut)[1:-1])
    pages = [((number * 7 + i * 13) % 4001).cast("string") for i in range(PER_PAYLOAD)]
    between = [part for page, text in zip(pages, texts[1:], strict=True) for part in (page, F.lit(text))]
    unnumbered = ",".join(
        json.dumps(json.loads(article(i)) | {"url": None}, separators=(",", ":"))
        for i in range(PER_PAYLOAD)
    )
    every = F.coalesce(F.concat(F.lit(texts[0]), *between), F.lit(unnumbered))
    key = F.to_json(F.struct("disasterNumber", "county_fips"), {"ignoreNullFields": "false"})
    return events.select(
        F.substr(key, F.lit(1), F.length(key) - 1).alias("_key"), number, every.alias("_every")
    ).select(
        F.concat(
            "_key",
            F.lit(',"articles":['),
            F.when(number % 2 == 0, F.col("_every")).otherwise(""),
            F.lit('],"timeline":['),
            "_every",
            F.lit("]}"),
        ).alias("value")
    )


@query(EVENT_ARTICLES_SQL)
def event_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine -> landed payloads -> title score -> one row per URL -> row key.

    Every event has a payload of 40 articles, of which the job takes 30; many have a URL in
    common with other events. Events with odd numbers have theirs in ``timeline``,
    beside an empty ``articles``. All goes through files and ``run_articles``.
    """
    root = scratch_path(spark, "event-articles")
    append_ndjson(enriched_spine(spark, sf_dir), f"{root}/spine", SPINE_LINES)
    keys = read_ndjson(spark, f"{root}/spine", SPINE).select(
        F.col("fema_disaster_number").alias("disasterNumber"), "county_fips"
    )
    append_lines(_landed_payloads(keys), f"{root}/payloads", PAYLOAD_LINES)
    article_plan.run_articles(
        spark, f"{root}/spine", f"{root}/payloads", f"{root}/ndjson", f"{root}/csv"
    )
    return _with_row_key(read_ndjson(spark, f"{root}/ndjson", ARTICLE))


def _with_row_key(kept: DataFrame) -> DataFrame:
    key = row_key(F.col("disasterNumber"), F.col("county_fips"), F.col("url"))
    return kept.select(
        key.alias("unique_entity_identifier"),
        *[c for c in kept.columns if c not in ("state", "county", "sourceCountry", "domain")],
    )


@query(EVENT_ARTICLES_SQL)
def stream_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same articles from a stream that is started twice: first the payloads of the later
    events are there, then also those of the earlier ones."""
    root = scratch_path(spark, "article-stream")
    append_ndjson(enriched_spine(spark, sf_dir), f"{root}/spine", SPINE_LINES)
    spine = read_ndjson(spark, f"{root}/spine", SPINE)
    events = fix_events(spark, spine, f"{root}/store", "v1")
    late = F.coalesce(F.col("date") >= "1998-01-01", F.lit(False))
    dates = spine.select(F.col("fema_disaster_number").alias("disasterNumber"), "county_fips", "date")
    for part in (late, ~late):
        of_part = dates.where(part).drop("date")
        keys = dates.drop("date").join(of_part, ["disasterNumber", "county_fips"])
        append_lines(_landed_payloads(keys), f"{root}/payloads", PAYLOAD_LINES)
        start_article_stream(
            spark, events, f"{root}/payloads", f"{root}/store", f"{root}/checkpoint", slots=4
        ).awaitTermination()
    return _with_row_key(articles_so_far(spark, f"{root}/store"))


EVENT_MATCH_SQL = f"""
WITH spine AS ({SPINE_SQL}), articles AS (
  SELECT 'http://h/' || CAST(o_orderkey AS VARCHAR) AS url, o_orderdate AS seen,
    c_name, c_mktsegment, CASE o_orderstatus WHEN 'F' THEN 'flood' WHEN 'O' THEN 'storm' END AS kind
  FROM orders JOIN customer ON o_custkey = c_custkey
), ranked AS (
  SELECT fema_disaster_number, url, row_number() OVER (
    PARTITION BY fema_disaster_number ORDER BY seen DESC, url) - 1 AS article_pos
  FROM spine JOIN articles ON county = c_name AND state = c_mktsegment AND disaster = kind
   AND seen BETWEEN CAST(window_start AS DATE) AND CAST(window_end AS DATE)
)
SELECT fema_disaster_number AS "disasterNumber", url, CAST(article_pos AS INT) AS article_pos
FROM ranked WHERE article_pos < 30
"""


@query(EVENT_MATCH_SQL)
def event_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and their newest articles from a local article table, by place and words.

    Every order is also an article, headed by its customer as the place.
    """
    places = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"
    )
    status = F.col("o_orderstatus")
    kind = F.when(status == "F", "Flash flood").when(status == "O", "STORM").otherwise("Calm")
    title = F.concat(
        kind, F.lit(" in "), F.col("c_name"), F.lit(" county ("), F.col("c_mktsegment"), F.lit(")")
    )
    local = (
        table(spark, sf_dir, "orders")
        .join(places, "o_custkey")
        .select(
            F.concat(F.lit("http://h/"), F.col("o_orderkey").cast("string")).alias("url"),
            title.alias("title"),
            F.col("o_orderdate").alias("seen"),
            F.lit("English").alias("language"),
        )
    )
    path = scratch_path(spark, "spine")
    append_ndjson(enriched_spine(spark, sf_dir), path, SPINE_LINES)
    events = article_plan.events_from_spine(read_ndjson(spark, path, SPINE))
    matched = article_plan.match_articles(events, local)
    return matched.select("disasterNumber", "url", "article_pos")


@query(
    """SELECT n_name AS state_name, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_fips,
         c_name || ' County' AS county_name,
         CASE WHEN c_custkey < 100 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0')
              ELSE CAST(c_custkey AS VARCHAR) END AS county_fips,
         lpad(CAST(c_nationkey AS VARCHAR), 2, '0') ||
         CASE WHEN c_custkey < 100 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0')
              ELSE CAST(c_custkey AS VARCHAR) END AS county_geoid,
         c_name AS county_name_clean
       FROM customer JOIN nation ON c_nationkey = n_nationkey"""
)
def county_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County rows from header-row payloads: nations are states, customers counties.

    Every county comes twice; the second copy has another name and is dropped.
    """

    def payload(header: tuple[str, ...], *rows: tuple) -> Column:
        cells = [F.array(*[F.lit(h) for h in header]), *[F.array(*row) for row in rows]]
        return F.to_json(F.array(*cells))

    code, county = F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string")
    label = F.concat(F.col("c_name"), F.lit(" County, "), code)
    states = table(spark, sf_dir, "nation").select(
        payload(
            ("NAME", "state"), (F.col("n_name"), F.col("n_nationkey").cast("string"))
        ).alias("value")
    )
    landed = table(spark, sf_dir, "customer").select(
        zero_pad(code, 2).alias("state_fips"),
        payload(
            ("NAME", "state", "county"), (label, code, county), (F.lit("Copy"), code, county)
        ).alias("value"),
    )
    return county_plan.county_dimension(
        county_plan.read_states(states), county_plan.read_state_counties(landed)
    )


@query(
    f"""WITH articles AS (
          SELECT o_orderkey, o_orderstatus AS state, CAST(o_custkey AS VARCHAR) AS county,
            {DISASTER_OF_PRIORITY_SQL} AS disaster, pos,
            strftime(CAST(o_orderdate AS DATE) + pos, '%Y-%m-%d') AS date,
            'http://' || o_orderstatus || ':80/' || page AS url,
            CASE pos WHEN 2 THEN 'A 5" pipe' WHEN 3 THEN 'Title, "3"' || chr(13) || chr(10) || 'b'
              ELSE 'x' END AS title
          FROM orders, (VALUES (2), (3), (4)) v(pos),
            LATERAL (SELECT CASE pos WHEN 4 THEN 'same' ELSE CAST(o_orderkey AS VARCHAR) || '/' ||
              CAST(pos AS VARCHAR) END AS page)
        )
        SELECT state, county, disaster, date,
          string_agg(title || '|' || url || '|' || state || ':80', ';' ORDER BY pos) AS articles
        FROM articles GROUP BY o_orderkey, state, county, disaster, date"""
)
def crawl_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed CSV payloads to articles by payload and date; every order is a payload.

    Its first two rows share a URL whose first copy has no date, so neither is kept. One
    row has a stray quote sign, one a line break inside quotes, and the last one's URL
    comes in other payloads of the same key too, where it stays.
    """
    status, day = F.col("o_orderstatus"), F.col("o_orderdate").cast("date")
    host = F.concat(F.lit("http://"), status, F.lit(":80/"))
    link = F.concat(host, F.col("o_orderkey").cast("string"), F.lit("/"))

    def row(url: Column, title: str, date: Column) -> Column:
        return F.concat(url, F.lit(f",{title},,"), date, F.lit("\r\n"))

    def page(name: str) -> Column:
        return F.concat(link, F.lit(name))

    def stamp(days: int) -> Column:
        return compact_ts(iso_text(F.date_add(day, days)))

    text = F.concat(
        F.lit("DocumentIdentifier,Title,SourceCommonName,Date\r\n"),
        row(page("twice"), "first", F.lit("undated")),
        row(page("twice"), "second", stamp(1)),
        row(page("2"), 'A 5" pipe', stamp(2)),
        row(page("3"), '"Title, ""3""\r\nb"', stamp(3)),
        row(F.concat(host, F.lit("same")), "x", stamp(4)),
    )
    landed = table(spark, sf_dir, "orders").select(
        status.alias("state"),
        F.col("o_custkey").cast("string").alias("county"),
        disaster_of_priority().alias("disaster"),
        text.alias("csv_text"),
    )
    by_date = crawl_plan.county_articles(crawl_plan.payload_days(landed))
    shown = F.transform("articles", lambda a: F.concat_ws("|", a["title"], a["url"], a["source"]))
    return by_date.withColumn("articles", F.array_join(shown, ";"))


def _article_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as article records; those of status P lack their URL."""
    number = F.col("o_orderkey")
    url = F.concat(F.lit("http://h/"), number.cast("string"), F.lit('?a,"b"'))
    given = {
        "disasterNumber": number,
        "county_fips": F.lpad(F.col("o_custkey").cast("string"), 9, "0"),
        "url": F.when(F.col("o_orderstatus") != "P", url),
        "title": F.lit("two\nlines"),
        "label": F.col("o_orderpriority"),
    }
    return table(spark, sf_dir, "orders").select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ARTICLE]
    )


@query(
    """SELECT file_kind, o_orderkey AS "disasterNumber",
         CASE WHEN o_orderstatus = 'P' THEN 'missingpk_' || file_kind || '_' ||
                CAST(row_number() OVER (PARTITION BY file_kind ORDER BY o_orderkey) - 1 AS VARCHAR)
              ELSE CAST(o_orderkey AS VARCHAR) || '_' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '_' ||
                substr(sha1('http://h/' || CAST(o_orderkey AS VARCHAR) || '?a,"b"'), 1, 10) END AS key,
         CASE WHEN o_orderstatus = 'P' THEN 'url' END AS missing
       FROM orders, (VALUES ('csv'), ('ndjson')) v(file_kind)"""
)
def keyed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys for both article files, read from files whose rows lie in a known order."""
    root = scratch_path(spark, "keyed")
    rows = _article_rows(spark, sf_dir)
    parts = rows.repartitionByRange("disasterNumber").sortWithinPartitions("disasterNumber")
    write_articles(parts, f"{root}/ndjson", f"{root}/unordered")
    write_csv(parts.select(*ARTICLE_CSV_COLUMNS), f"{root}/csv")
    keyed = {
        "csv": key_plan.keyed_csv(spark, f"{root}/csv"),
        "ndjson": key_plan.keyed_ndjson(spark, f"{root}/ndjson")[0],
    }
    csv_rows, ndjson_rows = (
        rows.select(
            F.lit(kind).alias("file_kind"),
            F.col("disasterNumber").cast("bigint").alias("disasterNumber"),
            F.col(ROW_KEY_COLUMN).alias("key"),
            F.col(key_plan.MISSING).alias("missing"),
        )
        for kind, rows in keyed.items()
    )
    return csv_rows.unionByName(ndjson_rows)


@query(
    f"""SELECT form, columns, o_orderkey AS "disasterNumber",
          CASE WHEN form = 'ndjson' THEN o_orderpriority END AS label
        FROM orders, (VALUES
          ('csv', '{",".join((ROW_KEY_COLUMN, *ARTICLE_CSV_COLUMNS))}'),
          ('ndjson', '{",".join((*ARTICLE.names, ROW_KEY_COLUMN))}')) v(form, columns)"""
)
def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed article files: 15 fields after the key in CSV, 17 before it in NDJSON."""
    root = scratch_path(spark, "conformed")
    write_articles(_article_rows(spark, sf_dir), f"{root}/ndjson", f"{root}/csv")
    key_plan.add_keys(
        spark, f"{root}/csv", f"{root}/ndjson", f"{root}/csv_keyed", f"{root}/ndjson_keyed"
    )
    from_csv = read_csv(spark, f"{root}/csv_keyed")
    csv_rows = from_csv.select(
        F.lit("csv").alias("form"),
        F.lit(",".join(from_csv.columns)).alias("columns"),
        F.col("disasterNumber").cast("bigint").alias("disasterNumber"),
        F.lit(None).cast("string").alias("label"),
    )
    record = F.col("value")
    ndjson_rows = spark.read.text(f"{root}/ndjson_keyed").select(
        F.lit("ndjson").alias("form"),
        F.array_join(F.json_object_keys(record), ",").alias("columns"),
        F.get_json_object(record, "$.disasterNumber").cast("bigint").alias("disasterNumber"),
        F.get_json_object(record, "$.label").alias("label"),
    )
    return csv_rows.unionByName(ndjson_rows)


SPINE_BASIC_SQL = (
    CLASSIFIED_SQL
    + """
SELECT m.c_mktsegment AS state, m.c_name AS county, fips AS county_fips,
  strftime(declared, '%Y-%m-%d') AS date, disaster, kind AS fema_incident_type,
  num AS fema_disaster_number, 'FEMA' AS source
FROM mapped m WHERE declared IS NOT NULL AND NOT bad_code AND c_name IS NOT NULL
"""
)


@query(SPINE_BASIC_SQL)
def spine_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 8-column spine, which goes by the declaration date alone."""
    return spine_plan.spine_basic(
        spine_plan.classify(
            declarations(spark, sf_dir), county_map(spark, sf_dir), dated_by=spine_plan.DECLARED
        )
    )


@query(
    """WITH k AS (
         SELECT l_orderkey, l_linenumber, l_partkey, substr(sha1(CAST(l_partkey AS VARCHAR)), 1, 2) AS short,
                sha1(CAST(l_partkey AS VARCHAR)) AS whole FROM lineitem
       ), g AS (
         SELECT short, min(whole) AS owner FROM k GROUP BY short HAVING count(DISTINCT whole) > 1
       )
       SELECT DISTINCT l_partkey, CASE WHEN owner <> whole THEN whole ELSE k.short END AS key
       FROM k LEFT JOIN g USING (short)"""
)
def keys_told_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes cut so short that many parts share one: all but its owner get the whole hash."""
    whole = F.sha1(F.col("l_partkey").cast("string"))
    rows = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.substring(whole, 1, 2).alias("key")
    )
    return told_apart(rows, "key", whole, whole)[0].distinct()
