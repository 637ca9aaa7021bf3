"""CSV, NDJSON, JSON-array and audit sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormledger.schemas import ARTICLE_CSV_COLUMNS


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV as Python's csv module writes it: empty cells bare, quotes doubled, blanks kept."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_ndjson(
    df: DataFrame, path: str, mode: str = "overwrite", packed: int | None = None
) -> None:
    """One JSON object per line; NULL fields are written as ``null``.

    With ``packed`` the files are gzipped and have at most so many lines each: such a file is
    read by one task, so it must not grow with the table.
    """
    writer = df.write.mode(mode).option("ignoreNullFields", False)
    if packed is not None:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", packed)
    writer.json(path)


def append_ndjson(df: DataFrame, path: str, packed: int | None = None) -> None:
    write_ndjson(df, path, mode="append", packed=packed)


def append_lines(lines: DataFrame, path: str, packed: int) -> None:
    """Add texts as lines, in gzipped files of at most ``packed`` lines each."""
    writer = lines.write.mode("append").option("compression", "gzip")
    writer.option("maxRecordsPerFile", packed).text(path)


def write_json_array(df: DataFrame, path: str, position: str) -> None:
    """One JSON array over all part files, in ``position`` order, one record per line.

    ``position`` names a 0-based row number without gaps, which is not written. The first
    line opens the array, the others begin with a comma, and the last one closes it, so
    the parts one after the other are the array, at any size, and no task holds it. An
    empty table is the line ``[]``.
    """
    last = df.agg(F.max(position)).first()[0]
    if last is None:
        lines = df.sparkSession.range(1).select(F.lit("[]").alias("value"))
    else:
        record = F.to_json(
            F.struct(*[c for c in df.columns if c != position]), {"ignoreNullFields": "false"}
        )
        opening = F.when(F.col(position) == 0, "[").otherwise(",")
        closing = F.when(F.col(position) == last, "]").otherwise("")
        lines = (
            df.repartitionByRange(position)
            .sortWithinPartitions(position)
            .select(F.concat(opening, record, closing).alias("value"))
        )
    lines.write.mode("overwrite").text(path)


def write_audit(df: DataFrame, root: str, run_id: str) -> None:
    """Add one run to an audit table. Writing the same run again replaces only that run."""
    df.write.mode("overwrite").parquet(f"{root}/run_id={run_id}")


def write_articles(articles: DataFrame, ndjson_path: str, csv_path: str) -> None:
    """The same rows as NDJSON with all fields and as CSV without the last two.

    The CSV is made from the NDJSON just written: the pipeline runs once, and both
    outputs agree even if an executor is lost in between.
    """
    write_ndjson(articles, ndjson_path)
    written = articles.sparkSession.read.schema(articles.schema).json(ndjson_path)
    write_csv(written.select(*ARTICLE_CSV_COLUMNS), csv_path)
