"""Primary keys for the article files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormledger.functions.keys import (
    KEY_PARTS,
    full_hash,
    missing_parts,
    row_key_or_fallback,
    wide_key,
)
from stormledger.functions.records import with_field
from stormledger.functions.text import strip
from stormledger.operators.unique import told_apart
from stormledger.schemas import ROW_KEY_COLUMN
from stormledger.sinks.writers import write_audit, write_csv
from stormledger.sources.csv_blocks import read_numbered_csv
from stormledger.sources.lines import number_lines
from stormledger.sources.ndjson import CORRUPT, parsed_line
from stormledger.storage import durable

MISSING = "missing_parts"
_KEY_FIELDS = T.StructType([T.StructField(name, T.StringType()) for name in KEY_PARTS])


def _keyed(rows: DataFrame, file_kind: str, index: str) -> tuple[DataFrame, DataFrame]:
    """(rows with key and missing parts, conflicts): keys that different URLs would share are
    told apart. Rows are read twice, the first time by their key's parts alone."""
    number, fips, url = (F.col(c) if c in rows.columns else F.lit("") for c in KEY_PARTS)
    keyed = rows.withColumns(
        {
            ROW_KEY_COLUMN: row_key_or_fallback(number, fips, url, file_kind, F.col(index)),
            MISSING: missing_parts(number, fips, url),
        }
    )
    whole = F.when(F.col(MISSING).isNull(), full_hash(url))
    return told_apart(keyed, ROW_KEY_COLUMN, whole, wide_key(number, fips, url))


def _keyed_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    rows = durable(read_numbered_csv(spark, path, "_index", "_file", across_files=True))
    columns = [c for c in rows.columns if c not in ("_index", "_file", ROW_KEY_COLUMN)]
    filled = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns]
    keyed, conflicts = _keyed(rows, "csv", "_index")
    return keyed.select(
        ROW_KEY_COLUMN, *filled, MISSING, F.col("_index").alias("_row_index")
    ), conflicts


def keyed_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV rows with the key column first, and ``MISSING`` and the row's place last.

    Fallback keys count the rows of all part files, so they are unique in the table.
    """
    return _keyed_csv(spark, path)[0]


def keyed_ndjson(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their record as text, key last; malformed lines).

    A record keeps all fields it came with, known or not, as they were written. A fallback
    key and a malformed line both carry the physical line index, which counts blank and
    malformed lines, through all part files. Lines are parsed once, as they are numbered.
    """
    return _keyed_ndjson(spark, path)[:2]


def _keyed_ndjson(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    line = {"_line": parsed_line(F.col("value"), _KEY_FIELDS)}
    rows = number_lines(spark, path, across_files=True, more=line).where(
        strip(F.col("value")) != ""
    )
    parsed = rows.where("_line.good").select("line_index", "value", "_line.row.*")
    good, conflicts = _keyed(parsed, "ndjson", "line_index")
    bad = rows.where("NOT _line.good").select("line_index", F.col("value").alias(CORRUPT))
    record = with_field(F.col("value"), ROW_KEY_COLUMN, F.col(ROW_KEY_COLUMN)).alias("record")
    kept = good.select("line_index", *KEY_PARTS, record, ROW_KEY_COLUMN, MISSING)
    return kept, bad, conflicts


def add_keys(
    spark: SparkSession,
    csv_path: str,
    ndjson_path: str,
    csv_out: str,
    ndjson_out: str,
    audit_root: str | None = None,
    run_id: str | None = None,
) -> dict[str, int]:
    """Key both article files; the two passes are independent.

    Rows that got a fallback key, malformed lines, and short keys that different URLs share are
    written below ``audit_root``, if given. Returns the totals, counted while writing.
    """
    seen = {n: Observation(n) for n in ("csv", "ndjson")}
    counts = (F.count("*").alias("rows"), F.count(MISSING).alias("fallback"))
    csv_rows, shared = _keyed_csv(spark, csv_path)
    write_csv(csv_rows.observe(seen["csv"], *counts).drop(MISSING, "_row_index"), csv_out)
    rows, bad, more_shared = _keyed_ndjson(spark, ndjson_path)
    rows.observe(seen["ndjson"], *counts).select("record").write.mode("overwrite").text(ndjson_out)
    totals = {f"{n}_{k}": seen[n].get[k] for n in seen for k in ("rows", "fallback")}
    if audit_root is not None:
        run = run_id or uuid.uuid4().hex
        warned = csv_rows.where(F.col(MISSING).isNotNull()).select(
            F.lit("csv").alias("file_kind"), F.col("_row_index").alias("place"), MISSING
        )
        more = rows.where(F.col(MISSING).isNotNull()).select(
            F.lit("ndjson").alias("file_kind"), F.col("line_index").alias("place"), MISSING
        )
        write_audit(warned.unionByName(more), f"{audit_root}/fallback_keys", run)
        write_audit(bad, f"{audit_root}/malformed", run)
        write_audit(
            shared.withColumn("file_kind", F.lit("csv")).unionByName(
                more_shared.withColumn("file_kind", F.lit("ndjson"))
            ),
            f"{audit_root}/shared_keys",
            run,
        )
    return totals | {"malformed": bad.count()}
