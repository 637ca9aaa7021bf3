"""Sources and sinks. Each query writes its table into the shared folder and reads it back."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormledger.catalog.registry import query, table
from stormledger.catalog.stand_ins import CLASSIFIED_SQL, county_map, declarations
from stormledger.functions import records
from stormledger.operators.numbering import index_rows
from stormledger.operators.rollups import counts_by
from stormledger.plans import spine as spine_plan
from stormledger.schemas import ARTICLE, DECLARATION_ARRAY
from stormledger.sinks import commits, writers
from stormledger.sources import csv_blocks, lines, ndjson, payloads, tabular
from stormledger.storage import scratch_path


@query(
    """SELECT c_mktsegment AS state_name, c_name AS county_name_clean,
              CAST(c_custkey AS VARCHAR) AS county_geoid
       FROM customer"""
)
def scan_csv_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "counties-csv")
    writers.write_csv(
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("County_GEOID"),
            F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ")).alias("STATE"),
            F.col("c_name").alias(" CountyClean "),
        ),
        path,
    )
    return tabular.read_counties(spark, path).select(
        "state_name", "county_name_clean", "county_geoid"
    )


@query(
    """SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS source,
              row_number() OVER (ORDER BY doc_id) - 1 AS row_index
       FROM documents"""
)
def scan_csv_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted line breaks in files that are read chunk by chunk, records numbered."""
    path = scratch_path(spark, "documents-csv")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    writers.write_csv(docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id"), path)
    rows = csv_blocks.read_numbered_csv(spark, path, across_files=True, chunk_bytes=1 << 16)
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "source", "row_index")


@query(
    """SELECT event_id, 'new ' || CAST(event_id AS VARCHAR) AS key,
              CASE event_type WHEN 'error' THEN 'old' END AS inner_key,
              CASE event_type WHEN 'error' THEN 3 ELSE 2 END AS fields
       FROM events"""
)
def record_edit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-level field set in records that have it nowhere, further inside, as a list, an
    object, or twice."""
    kind, event_id = F.col("event_type"), F.col("event_id").cast("string")
    old = (
        F.when(kind == "error", ', "meta": {"key": "old"}')
        .when(kind == "view", ', "key": ["x", {"key": "}"}]')
        .when(kind == "click", ', "key": {"key": 1}, "k\\u0065y": "again"')
        .otherwise("")
    )
    record = F.concat(F.lit('{"id": '), event_id, old, F.lit("}"))
    edited = records.with_field(record, "key", F.concat(F.lit("new "), event_id))
    return (
        table(spark, sf_dir, "events")
        .select("event_id", edited.alias("record"))
        .select(
            "event_id",
            F.get_json_object("record", "$.key").alias("key"),
            F.get_json_object("record", "$.meta.key").alias("inner_key"),
            F.size(F.json_object_keys("record")).alias("fields"),
        )
    )


ORDER_LINE = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string"


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def scan_ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-ndjson")
    record = F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))
    with_blanks = F.explode(F.array(record, F.lit(""), F.lit("   ")))
    table(spark, sf_dir, "orders").select(with_blanks.alias("value")).write.text(path)
    return ndjson.read_ndjson(spark, path, ORDER_LINE)


@query(
    """SELECT CASE WHEN event_type IN ('error', 'view') THEN 'malformed' ELSE 'good' END AS status,
              count(*) AS n, CAST(sum(CASE WHEN event_type NOT IN ('error', 'view') THEN event_id END)
              AS BIGINT) AS event_ids
       FROM events GROUP BY 1"""
)
def scan_ndjson_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "events-ndjson")
    record = F.to_json(F.struct("event_id", "user_id", "event_type"))
    # A line cut short, as an interrupted writer leaves it; one with trailing text; and
    # numbers written as strings, which are fine.
    cut = F.substring(record, F.lit(1), F.length(record) - 9)
    kind = F.col("event_type")
    quoted = F.regexp_replace(record, r'"event_id":(\d+)', '"event_id":"$1"')
    line = (
        F.when(kind == "error", cut)
        .when(kind == "view", F.concat(record, F.lit(" trailing")))
        .when(kind == "click", quoted)
        .otherwise(record)
    )
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, event_type string")
    good, bad = ndjson.read_ndjson_tolerant(spark, path, schema)
    rows = good.select(F.lit("good").alias("status"), "event_id").unionByName(
        bad.select(F.lit("malformed").alias("status"), F.lit(None).cast("bigint").alias("event_id"))
    )
    return rows.groupBy("status").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("event_ids")
    )


def page_lines(rows: DataFrame, key: str, size: int = 1000) -> DataFrame:
    """Declarations as page objects, one per line; a page covers ``size`` key values."""
    page = F.floor(F.col(key) / F.lit(size)).alias("_page")
    paged = rows.groupBy(page).agg(F.collect_list(F.struct("*")).alias(DECLARATION_ARRAY))
    return paged.select(F.to_json(F.struct(DECLARATION_ARRAY)).alias("value"))


@query(
    """SELECT o_orderkey AS "disasterNumber", o_orderstatus AS "declarationType",
              CAST(o_custkey % 56 AS VARCHAR) AS "fipsStateCode"
       FROM orders"""
)
def explode_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "pages")
    page_lines(declarations(spark, sf_dir), "disasterNumber").write.text(path)
    return payloads.read_declaration_pages(spark, path, multi_line=False).select(
        "disasterNumber", "declarationType", "fipsStateCode"
    )


@query("SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS state FROM customer")
def header_row_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = F.array(F.lit("NAME"), F.lit("state"))
    row = F.array(F.col("c_name"), F.col("c_nationkey").cast("string"))
    payload = table(spark, sf_dir, "customer").select(
        F.to_json(F.array(header, row)).alias("value")
    )
    return payloads.header_row_json(payload, F.col("value"), ["name", "state"]).drop("row_pos")


@query(
    """SELECT p_partkey, pos AS article_pos, 'http://h/' || CAST(p_partkey AS VARCHAR) || '/' ||
              CAST(pos AS VARCHAR) AS url, '20240110' || lpad(CAST(p_size AS VARCHAR), 6, '0') AS seen,
              CASE pos WHEN 0 THEN p_name || ', "' || p_type || '"' || chr(13) || chr(10) || 'next'
                   WHEN 1 THEN 'A 5" ' || p_name ELSE 'ab"c' END AS title
       FROM part, (VALUES (0), (1), (2)) v(pos) WHERE p_type <> 'PROMO'"""
)
def csv_payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    marker = F.when(F.col("p_type") == "PROMO", "Link").otherwise("DocumentIdentifier")
    url = F.concat(F.lit("http://h/"), F.col("p_partkey").cast("string"))
    seen = F.concat(F.lit("20240110"), F.lpad(F.col("p_size").cast("string"), 6, "0"))
    text = F.concat(
        F.concat(F.lit("Title,"), marker, F.lit(",Date\r\n")),
        F.concat(
            F.lit('"'), F.col("p_name"), F.lit(', ""'), F.col("p_type"), F.lit('""\r\nnext",')
        ),
        F.concat(url, F.lit("/0,"), seen, F.lit("\r\n")),
        F.concat(F.lit('A 5" '), F.col("p_name"), F.lit(","), url, F.lit("/1,"), seen, F.lit("\r\n\r\n")),
        F.concat(F.lit('"ab""c",'), url, F.lit("/2,"), seen),
    )
    landed = table(spark, sf_dir, "part").select("p_partkey", text.alias("csv_text"))
    fields = ["DocumentIdentifier", "Date", "Title"]
    rows = payloads.csv_payload_rows(landed, "csv_text", fields, "p_partkey")
    return rows.select(
        "p_partkey",
        "article_pos",
        F.col("DocumentIdentifier").alias("url"),
        F.col("Date").alias("seen"),
        F.col("Title").alias("title"),
    )


@query(
    """SELECT event_id, pos AS article_pos,
              CASE WHEN event_type = 'click' THEN 'a' ELSE 't' END || CAST(pos AS VARCHAR) AS title
       FROM events, (VALUES (0), (1)) v(pos) WHERE event_type <> 'error'"""
)
def explode_payload_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    def items(prefix: str):
        return F.array(*[F.struct(F.lit(f"{prefix}{i}").alias("title")) for i in range(2)])

    none = F.array().cast("array<struct<title: string>>")
    kind = F.col("event_type")
    landed = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "click", items("a")).when(kind == "view", none).alias("articles"),
        F.when(kind != "error", items("t")).alias("timeline"),
    )
    return payloads.explode_articles(landed, "event_id")


DISASTER_OF_PRIORITY = {
    "1-URGENT": "hurricane",
    "2-HIGH": "flood",
    "3-MEDIUM": "storm",
    "4-NOT SPECIFIED": "",
    "5-LOW": "drought",
}


def disaster_of_priority():
    chain = F.when(F.lit(False), "")
    for priority, disaster in DISASTER_OF_PRIORITY.items():
        chain = chain.when(F.col("o_orderpriority") == priority, disaster)
    return chain


DISASTER_OF_PRIORITY_SQL = (
    "CASE o_orderpriority "
    + " ".join(f"WHEN '{p}' THEN '{d}'" for p, d in DISASTER_OF_PRIORITY.items())
    + " END"
)


@query(
    f"""SELECT DISTINCT o_orderstatus AS state, CAST(o_custkey AS VARCHAR) AS county,
               {DISASTER_OF_PRIORITY_SQL} AS disaster
        FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'"""
)
def done_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "progress-log")
    log = table(spark, sf_dir, "orders").select(
        F.concat(F.col("o_orderstatus"), F.lit(" ")).alias("State"),
        F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias(" county"),
        disaster_of_priority().alias("DISASTER"),
        F.lit(0).alias("date_groups"),
        F.lit(0).alias("articles"),
    )
    writers.write_csv(log, path)
    return tabular.read_done_keys(spark, path)


@query("SELECT doc_id, text, lang, source FROM documents")
def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "documents-csv")
    writers.write_csv(
        table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), path
    )
    return tabular.read_csv(spark, path).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        "lang",
        "source",
    )


@query(
    """SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS segment,
              CASE WHEN c_custkey = (SELECT min(c_custkey) FROM customer) THEN '[' ELSE ',' END AS mark,
              c_custkey = (SELECT max(c_custkey) FROM customer) AS closes FROM customer"""
)
def sink_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customers-json")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment")
    )
    writers.write_json_array(index_rows(rows, ["c_custkey"]), path, "row_index")
    record = "c_custkey bigint, c_name string, segment string"
    lines = spark.read.text(path).select(F.substring("value", 1, 1).alias("mark"), "value")
    entry = F.regexp_replace(F.substr("value", F.lit(2)), r"\]$", "")
    return lines.select(
        "mark",
        F.col("value").endswith("]").alias("closes"),
        F.from_json(entry, record).alias("r"),
    ).select("mark", "closes", "r.*")


@query(
    """SELECT s_suppkey, s_name, CASE WHEN s_acctbal > 5000 THEN s_nationkey END AS nation
       FROM supplier"""
)
def sink_ndjson_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "suppliers-ndjson")
    rich = F.col("s_acctbal") > 5000
    rows = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.when(rich, F.col("s_nationkey")).alias("nation"), rich.alias("_rich")
    )
    writers.append_ndjson(rows.where("_rich").drop("_rich"), path)
    writers.append_ndjson(rows.where("NOT _rich").drop("_rich"), path)
    return ndjson.read_ndjson(spark, path, "s_suppkey bigint, s_name string, nation int")


@query("SELECT doc_id, text, lang, n_chars FROM documents")
def sink_ndjson_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "documents-ndjson")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    writers.write_ndjson(rows.select("doc_id", "lang"), path)
    writers.write_ndjson(rows, path)
    return ndjson.read_ndjson(spark, path, rows.schema)


@query(
    CLASSIFIED_SQL
    + """SELECT run_id, reason AS skip_reason, count(*) AS n
         FROM classified, (VALUES (1), (2)) v(run_id) GROUP BY ALL"""
)
def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "audit")
    log = spine_plan.spine_log(
        spine_plan.classify(declarations(spark, sf_dir), county_map(spark, sf_dir))
    )
    for run in ("1", "2", "2"):
        writers.write_audit(log, root, run)
    return counts_by(spark.read.parquet(root), "run_id", "skip_reason")


@query(
    """SELECT v.sink, p_partkey AS "disasterNumber", p_name AS title, p_brand AS domain,
              CASE WHEN v.sink = 'ndjson' THEN p_type END AS label
       FROM part, (VALUES ('ndjson'), ('csv')) v(sink)"""
)
def dual_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "articles")
    given = {"disasterNumber": "p_partkey", "title": "p_name", "domain": "p_brand", "label": "p_type"}
    articles = table(spark, sf_dir, "part").select(
        *[
            (F.col(given[f.name]) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ARTICLE
        ]
    )
    writers.write_articles(articles, f"{root}/ndjson", f"{root}/csv")
    shown = ["sink", "disasterNumber", "title", "domain", "label"]
    from_ndjson = ndjson.read_ndjson(spark, f"{root}/ndjson", ARTICLE)
    from_csv = tabular.read_csv(spark, f"{root}/csv").withColumn(
        "disasterNumber", F.col("disasterNumber").cast("bigint")
    )
    return (
        from_ndjson.withColumn("sink", F.lit("ndjson"))
        .select(*shown)
        .unionByName(
            from_csv.withColumns({"sink": F.lit("csv"), "label": F.lit(None).cast("string")}).select(
                *shown
            )
        )
    )


@query("SELECT count(*) AS lines FROM orders")
def line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-text")
    blank = F.when(F.col("o_orderstatus") == "F", "").otherwise(" \t ")
    both = F.explode(F.array(F.col("o_orderkey").cast("string"), blank))
    table(spark, sf_dir, "orders").select(both.alias("value")).write.text(path)
    return lines.count_lines(spark.read.text(path))


@query(
    """SELECT 2 * count(*) AS lines, 2 * count(*) AS positions, 2 * count(*) AS last_plus_one,
              count(*) AS records_on_even_lines
       FROM events"""
)
def line_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Physical line numbers: blank lines count, and every file counts from 0."""
    path = scratch_path(spark, "events-text")
    record = F.to_json(F.struct("event_id", "event_type"))
    table(spark, sf_dir, "events").select(
        F.explode(F.array(record, F.lit(""))).alias("value")
    ).write.text(path)
    per_file = (
        lines.number_lines(spark, path)
        .groupBy("file")
        .agg(
            F.count("*").alias("lines"),
            F.count_distinct("line_index").alias("positions"),
            (F.max("line_index") + 1).alias("last_plus_one"),
            F.count_if((F.col("value") != "") & (F.col("line_index") % 2 == 0)).alias("even"),
        )
    )
    return per_file.agg(
        F.sum("lines").alias("lines"),
        F.sum("positions").alias("positions"),
        F.sum("last_plus_one").alias("last_plus_one"),
        F.sum("even").alias("records_on_even_lines"),
    )


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'P')
       UNION ALL
       SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('P', 'O')"""
)
def union_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping pulls appended to one output: repeated rows stay."""
    path = scratch_path(spark, "pulls")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for pulled in (["F", "P"], ["P", "O"]):
        writers.append_ndjson(rows.where(F.col("o_orderstatus").isin(pulled)), path)
    return ndjson.read_ndjson(spark, path, rows.schema)


@query(
    """SELECT run_id, o_orderkey, o_totalprice, count(*) OVER (PARTITION BY run_id) AS counted
       FROM orders JOIN (VALUES ('a', 'F'), ('a', 'P'), ('b', 'P'), ('b', 'O')) v(run_id, status)
         ON status = o_orderstatus"""
)
def run_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pulls of two outputs each. Each is cut off once between its outputs, and run twice
    after that: rows and totals count once."""
    root = scratch_path(spark, "committed-runs")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    log = commits.RunLog(spark, f"{root}/runs")
    outputs = {
        "rows": commits.Output(f"{root}/rows"),
        "log": commits.Output(f"{root}/log", by_run=True),
    }

    def pull(run_id: str, statuses: list[str], cut: bool):
        def write(folder: dict[str, str]) -> dict:
            pulled = rows.where(F.col("o_orderstatus").isin(statuses))
            writers.write_ndjson(pulled.withColumn("run", F.lit(run_id)), folder["rows"])
            if cut:
                raise InterruptedError
            landed = ndjson.read_ndjson(spark, folder["rows"], "o_orderkey bigint, run string")
            landed.write.parquet(folder["log"])
            return {"rows": landed.count()}

        return write

    for run_id, statuses in (("a", ["F", "P"]), ("b", ["P", "O"])):
        with contextlib.suppress(InterruptedError):
            log.run(run_id, outputs, pull(run_id, statuses, cut=True))
        for _ in range(2):
            log.run(run_id, outputs, pull(run_id, statuses, cut=False))
    counted = spark.createDataFrame(
        [(r["run_id"], r["totals"]["rows"]) for r in log.records()], "run_id string, counted bigint"
    )
    shown = ndjson.read_ndjson(
        spark, f"{root}/rows", "o_orderkey bigint, o_totalprice double, run string"
    )
    logged = spark.read.parquet(f"{root}/log").select("run_id", "o_orderkey")
    return (
        shown.withColumnRenamed("run", "run_id")
        .join(logged, ["run_id", "o_orderkey"])
        .join(counted, "run_id")
        .select("run_id", "o_orderkey", "o_totalprice", "counted")
    )
