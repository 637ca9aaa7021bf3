"""Sorting, numbering and dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.catalog.expressions import EVENT_URL_SQL, event_url
from stormledger.catalog.registry import query, table
from stormledger.operators import dedup, numbering, ranking
from stormledger.operators.seen import SeenUrls
from stormledger.operators.selection import Key, rows_between
from stormledger.storage import scratch_path


@query(
    """SELECT c_nationkey, c_custkey, c_name,
              row_number() OVER (ORDER BY c_nationkey, c_custkey) - 1 AS place FROM customer"""
)
def sort_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_name")
    return ranking.ordered(rows, ["c_nationkey", "c_custkey"])


@query(
    """SELECT *, row_number() OVER (ORDER BY user_id, date DESC) - 1 AS place
       FROM (SELECT user_id, CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY ALL)"""
)
def sort_date_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_date = table(spark, sf_dir, "events").groupBy(
        "user_id", F.col("ts").cast("date").alias("date")
    )
    counted = by_date.agg(F.count("*").alias("n"))
    return ranking.ordered(counted, ["user_id", F.col("date").desc()])


@query(
    """SELECT user_id, event_id, CAST(rank AS INT) AS rank FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rank
         FROM events) WHERE rank <= 3"""
)
def topn_per_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = ranking.top_n_per_group(
        table(spark, sf_dir, "events").select("user_id", "event_id", "ts"),
        ["user_id"],
        [F.col("ts").desc(), F.col("event_id")],
        3,
    )
    return newest.drop("ts")


@query(
    """SELECT o_orderkey, o_orderpriority FROM orders
       ORDER BY o_orderdate DESC, o_orderkey LIMIT 2000 OFFSET 1000"""
)
def page_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    newest = [Key("o_orderdate", descending=True), Key("o_orderkey")]
    return ranking.page_slice(orders, newest, skip=1000, pages=2).drop("o_orderdate")


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice, rank FROM (
         SELECT *, row_number() OVER (ORDER BY l_extendedprice, l_shipdate DESC, l_orderkey, l_linenumber,
                                      l_partkey, l_suppkey) - 1 AS rank, count(*) OVER () AS n FROM lineitem)
       WHERE rank >= n // 2 AND rank < n // 2 + 500"""
)
def rows_at_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows from the middle of an order: pivots close in on both sides of them."""
    keys = [Key("l_extendedprice"), Key("l_shipdate", descending=True)]
    keys += [Key(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    items = table(spark, sf_dir, "lineitem").select(*[k.name for k in keys])
    middle = items.count() // 2
    found = rows_between(items, keys, middle, middle + 500, few=2000)
    return found.select("l_orderkey", "l_linenumber", "l_extendedprice", "rank")


@query(
    """SELECT o_orderkey, o_custkey, row_number() OVER (
              ORDER BY sha1('7:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS place
       FROM orders"""
)
def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.seeded_order(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], seed=7
    )


@query(
    """SELECT p_partkey, (row_number() OVER (ORDER BY p_name, p_partkey) - 1) // 20 AS chunk,
              (row_number() OVER (ORDER BY p_name, p_partkey) - 1) % 20 AS pos_in_chunk FROM part"""
)
def chunk_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return numbering.assign_chunks(parts, ["p_name", "p_partkey"]).drop("p_name")


@query(
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_index
       FROM orders"""
)
def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return numbering.index_rows(orders, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (
         PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1"""
)
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate"
    )
    return dedup.keep_first(orders, ["o_custkey"], "o_orderdate", "o_orderkey").drop("o_orderdate")


@query(
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (
         PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
       WHERE r = 1"""
)
def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate"
    )
    return dedup.keep_last(orders, ["o_custkey"], "o_orderdate", "o_orderkey").drop("o_orderdate")


ITEM_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")
ITEM_ORDER_SQL = ", ".join(ITEM_ORDER)


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_partkey", *ITEM_ORDER)


@query(
    f"""SELECT l_partkey, l_orderkey, l_suppkey FROM (SELECT *, row_number() OVER (
          PARTITION BY l_partkey ORDER BY {ITEM_ORDER_SQL}) AS r FROM lineitem)
        WHERE r = 1 AND l_returnflag = 'R'"""
)
def dedup_before_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    kept = dedup.dedup_then_filter(_items(spark, sf_dir), ["l_partkey"], ITEM_ORDER, returned)
    return kept.select("l_partkey", "l_orderkey", "l_suppkey")


@query(
    f"""SELECT l_partkey, l_orderkey, l_suppkey FROM (SELECT *, row_number() OVER (
          PARTITION BY l_partkey ORDER BY {ITEM_ORDER_SQL}) AS r FROM lineitem
          WHERE l_returnflag = 'R') WHERE r = 1"""
)
def dedup_after_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    kept = dedup.filter_then_dedup(_items(spark, sf_dir), ["l_partkey"], ITEM_ORDER, returned)
    return kept.select("l_partkey", "l_orderkey", "l_suppkey")


FIRST_URL_SQL = f"""
SELECT url, l_orderkey FROM (SELECT *, row_number() OVER (
  PARTITION BY split_part(url, '?', 1) ORDER BY {ITEM_ORDER_SQL}) AS r
  FROM (SELECT *, {EVENT_URL_SQL} AS url FROM lineitem)) WHERE r = 1
"""


@query(FIRST_URL_SQL)
def first_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per URL without its query part, over all events."""
    linked = _items(spark, sf_dir).withColumn("url", event_url())
    return dedup.keep_first_url(linked, "url", *ITEM_ORDER).select("url", "l_orderkey")


@query(FIRST_URL_SQL)
def seen_url_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, found run by run: each run is asked of an index of all earlier ones."""
    linked = _items(spark, sf_dir).withColumn("url", event_url())
    known = SeenUrls(spark, scratch_path(spark, "seen-urls"), slots=4, fanout=2)
    years = F.year("l_shipdate")
    runs = [years < 1996, years.isin(1996, 1997), years.isin(1998, 1999), years >= 2000]
    for i, of_run in enumerate(runs):
        known.add(f"run{i}", linked.where(of_run), "url", *ITEM_ORDER)
    known.add("run1", linked.limit(0), "url")  # repeated: nothing is added or lost
    found = [known.rows(f"run{i}") for i in range(len(runs))]
    rows = found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])
    return rows.select("url", "l_orderkey")
