"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.catalog.files import DISASTER_OF_PRIORITY_SQL, disaster_of_priority
from stormledger.catalog.registry import query, table
from stormledger.catalog.stand_ins import CLASSIFIED_SQL, county_map, declarations
from stormledger.functions.dates import event_window
from stormledger.functions.fixed import DISASTERS, MAX_ARTICLES_PER_EVENT
from stormledger.operators import joins, phrases
from stormledger.operators.positions import PositionalIndex
from stormledger.plans import crawl
from stormledger.plans import spine as spine_plan
from stormledger.plans.colocated import buckets_for, save_bucketed
from stormledger.sources.payloads import explode_articles
from stormledger.storage import scratch_path


def _orders_with_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stormledger.functions.codes import compose_geoid

    return declarations(spark, sf_dir).select(
        F.col("disasterNumber").alias("o_orderkey"),
        compose_geoid(F.col("fipsStateCode"), F.col("fipsCountyCode")).alias("county_fips"),
    )


@query(
    CLASSIFIED_SQL
    + """SELECT num AS o_orderkey, fips AS county_fips, c_mktsegment AS state_name,
                c_name AS county_name_clean FROM classified WHERE c_name IS NOT NULL"""
)
def lookup_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders_with_code(spark, sf_dir)
    return joins.lookup(orders, county_map(spark, sf_dir), ["county_fips"])


@query(
    CLASSIFIED_SQL
    + """SELECT CASE WHEN declared IS NULL THEN NULL ELSE strftime(declared, '%Y-%m-%d') END AS date,
           CASE WHEN reason = '' THEN c_mktsegment ELSE 'S' || st END AS state,
           CASE WHEN reason IN ('no_dates', 'bad_fips') THEN '' ELSE fips END AS county_fips,
           CASE WHEN reason = '' THEN c_name ELSE '' END AS county,
           kind AS "incidentType",
           CASE WHEN reason = 'no_dates' THEN '' ELSE disaster END AS disaster,
           num AS "disasterNumber",
           CASE WHEN reason = 'no_dates' THEN '' ELSE ws END AS window_start,
           CASE WHEN reason = 'no_dates' THEN '' ELSE we END AS window_end,
           reason AS skip_reason, 'S' || st AS state_abbr
         FROM classified"""
)
def lookup_left_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit log: unmatched declarations stay, with their reason."""
    return spine_plan.spine_log(
        spine_plan.classify(declarations(spark, sf_dir), county_map(spark, sf_dir))
    )


@query(
    """SELECT c_custkey, c_name, n_name AS state_name
       FROM customer JOIN nation ON c_nationkey = n_nationkey"""
)
def state_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("state"), F.col("n_name").alias("state_name")
    )
    counties = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("c_nationkey").alias("state")
    )
    return joins.lookup(counties, states, ["state"]).drop("state")


def _customer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.work_keys(
        table(spark, sf_dir, "customer").select(
            F.col("c_mktsegment").alias("state"), F.col("c_custkey").cast("string").alias("county")
        )
    )


DISASTER_VALUES = ", ".join(f"('{d}')" for d in DISASTERS)
WORK_KEYS_SQL = f"""SELECT c_mktsegment AS state, CAST(c_custkey AS VARCHAR) AS county, disaster
  FROM customer, (VALUES {DISASTER_VALUES}) v(disaster)"""


@query(WORK_KEYS_SQL)
def work_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_keys(spark, sf_dir)


@query(
    f"""SELECT * FROM ({WORK_KEYS_SQL}) k WHERE NOT EXISTS (
          SELECT 1 FROM orders JOIN customer ON o_custkey = c_custkey
          WHERE c_mktsegment = k.state AND CAST(o_custkey AS VARCHAR) = k.county
            AND {DISASTER_OF_PRIORITY_SQL} = k.disaster)"""
)
def pending_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("state")
    )
    done = (
        table(spark, sf_dir, "orders")
        .select("o_custkey", disaster_of_priority().alias("disaster"))
        .distinct()
        .join(segments, "o_custkey")
        .select("state", F.col("o_custkey").cast("string").alias("county"), "disaster")
    )
    return crawl.pending_keys(_customer_keys(spark, sf_dir), done)


def dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as events: a nation and the padded window of the order date."""
    nations = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation")
    )
    day = F.col("o_orderdate").cast("date")
    start, end = event_window(day, day, day)
    return joins.lookup(
        table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_custkey", start.alias("window_start"), end.alias("window_end")
        ),
        nations,
        ["o_custkey"],
    ).drop("o_custkey")


def dated_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as articles: the supplier's nation and the ship date."""
    nations = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation")
    )
    return joins.lookup(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
        ),
        nations,
        ["l_suppkey"],
    )


PAIRS_SQL = """
  SELECT o_orderkey, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN (lineitem JOIN supplier ON l_suppkey = s_suppkey) ON s_nationkey = c_nationkey
   AND l_shipdate BETWEEN CAST(o_orderdate AS DATE) - INTERVAL 7 DAY
                      AND CAST(o_orderdate AS DATE) + INTERVAL 14 DAY
"""


@query(
    """SELECT e.o_orderkey, l_orderkey, l_linenumber, l_partkey, l_suppkey
       FROM orders e JOIN orders p ON e.o_custkey = p.o_custkey
       JOIN lineitem ON l_orderkey = p.o_orderkey
        AND l_shipdate BETWEEN CAST(e.o_orderdate AS DATE) - INTERVAL 7 DAY
                           AND CAST(e.o_orderdate AS DATE) + INTERVAL 14 DAY"""
)
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as events and line items as articles, both at the place of their customer."""
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    start, end = event_window(day, day, day)
    events = orders.select(
        "o_orderkey", "o_custkey", start.alias("window_start"), end.alias("window_end")
    )
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    places = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    pairs = joins.interval_join(
        events,
        joins.lookup(items, places, ["l_orderkey"]),
        ["o_custkey"],
        "window_start",
        "window_end",
        "l_shipdate",
    )
    return pairs.select("o_orderkey", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


TIE_BREAK = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    f"""SELECT o_orderkey, {", ".join(TIE_BREAK)}, CAST(rank AS INT) AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY o_orderkey
            ORDER BY l_shipdate DESC, {", ".join(TIE_BREAK)}) AS rank FROM ({PAIRS_SQL}))
        WHERE rank <= {MAX_ARTICLES_PER_EVENT}"""
)
def newest_in_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest articles of every event, without building its full list of pairs."""
    newest = joins.newest_in_window(
        dated_events(spark, sf_dir),
        dated_articles(spark, sf_dir),
        ["nation"],
        "window_start",
        "window_end",
        "l_shipdate",
        TIE_BREAK,
        MAX_ARTICLES_PER_EVENT,
    )
    return newest.select("o_orderkey", *TIE_BREAK, "rank")


PAYLOAD_SQL = """SELECT o_orderkey, o_orderpriority, l_partkey, l_linenumber
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""


def _events_and_payloads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    item = F.struct("l_partkey", "l_linenumber")
    none = F.lit(None).cast("array<struct<l_partkey: bigint, l_linenumber: int>>")
    payloads = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.array(item).alias("articles"),
        none.alias("timeline"),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), payloads


def _attached(events: DataFrame, payloads: DataFrame) -> DataFrame:
    return explode_articles(
        events.join(payloads, "o_orderkey"), "o_orderkey", "o_orderpriority"
    ).drop("article_pos")


@query(PAYLOAD_SQL)
def payload_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attached(*_events_and_payloads(spark, sf_dir))


@query(PAYLOAD_SQL)
def colocated_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from tables saved in buckets, which meet without a shuffle."""
    saved = []
    sides = _events_and_payloads(spark, sf_dir)
    buckets = buckets_for(*sides)
    for rows in sides:
        path = scratch_path(spark, "bucketed")
        name = path.rpartition("/")[2].replace("-", "_")
        save_bucketed(rows, name, path, ["o_orderkey"], buckets)
        saved.append(spark.table(name))
    return _attached(*saved)


PHRASE_SQL = r"""WITH phrases AS (
          SELECT DISTINCT unnest(string_split(text, '.')) AS phrase FROM benchmark
        ), spelled AS (
          SELECT phrase, trim(regexp_replace(lower(phrase), '[^\p{L}\p{N}]+', ' ', 'g')) AS words
          FROM phrases
        ), docs AS (
          SELECT doc_id, ' ' || trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) || ' '
            AS words FROM documents
        )
        SELECT doc_id, phrase FROM docs JOIN spelled
          ON contains(docs.words, ' ' || spelled.words || ' ') WHERE spelled.words <> ''"""


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.explode(F.split("text", r"\.")).alias("phrase")
    )


@query(PHRASE_SQL)
def phrase_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a sentence of the benchmark texts."""
    docs = table(spark, sf_dir, "documents")
    return phrases.find_phrases(docs, ["doc_id"], "text", _sentences(spark, sf_dir))


@query(PHRASE_SQL)
def indexed_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stored index of the documents, written in two runs and merged."""
    docs = table(spark, sf_dir, "documents")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    index = PositionalIndex(spark, scratch_path(spark, "positions"), "doc_id bigint", 8, fanout=2)
    for run, of_run in (("english", english), ("other", ~english)):
        index.add(run, docs.where(of_run), "text")
    return index.find(_sentences(spark, sf_dir)).drop("places")
