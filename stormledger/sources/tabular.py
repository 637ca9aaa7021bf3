"""CSV with a header, read as strings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.functions.text import strip
from stormledger.schemas import COUNTY_ALIASES, STATE_ALIASES, WORK_KEY
from stormledger.sources.csv_blocks import read_numbered_csv


def resolve_column(columns: Sequence[str], aliases: Sequence[str]) -> str | None:
    """Header name for the first alias present, ignoring case and outer blanks."""
    by_lower = {name.strip().lower(): name for name in columns}
    return next((by_lower[a] for a in aliases if a in by_lower), None)


def read_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """All-string CSV; a missing cell reads as NULL or empty.

    Quoted line breaks need ``multi_line``, which gives every file to one task. Files
    without them can be read with ``multi_line=False`` and are then split. A folder
    whose files disagree on the header is an error, not a silent mix-up.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def select_aliased(
    df: DataFrame,
    aliases: Mapping[str, Sequence[str]],
    optional: Sequence[str] = (),
    trim: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rename header spellings to canonical names; NULL cells become empty strings.

    Raises before any job runs when a column that is not optional is missing.
    """
    found = {name: resolve_column(df.columns, names) for name, names in aliases.items()}
    missing = [n for n, header in found.items() if header is None and n not in optional]
    if missing:
        raise ValueError(f"no column for {missing} among {df.columns}")
    picked = []
    for name, header in found.items():
        if header is None:
            continue
        cell = F.coalesce(df[f"`{header}`"], F.lit(""))
        picked.append((strip(cell) if trim else cell).alias(name))
    return df.select(*keep, *picked)


def read_counties(spark: SparkSession, path: str) -> DataFrame:
    """County file as (state_name, county_name_clean) plus the code columns it has.

    Rows without a state or a county name are dropped. ``file`` and ``row_index``
    say where a row stood.
    """
    raw = read_numbered_csv(spark, path)
    named = select_aliased(
        raw,
        {
            "state_name": STATE_ALIASES,
            "county_name_clean": COUNTY_ALIASES,
            "county_geoid": ("county_geoid",),
            "state_fips": ("state_fips",),
            "county_fips": ("county_fips",),
        },
        optional=("county_geoid", "state_fips", "county_fips"),
        trim=True,
        keep=("file", "row_index"),
    )
    return named.where((F.col("state_name") != "") & (F.col("county_name_clean") != ""))


def read_done_keys(spark: SparkSession, path: str) -> DataFrame:
    """Distinct work keys of a progress log.

    A log that is absent, empty or lacks a key column counts as no work done yet;
    rows with an empty part are ignored.
    """
    nothing = spark.createDataFrame([], ", ".join(f"{name} string" for name in WORK_KEY))
    try:
        log = read_csv(spark, path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return nothing
    if any(resolve_column(log.columns, (name,)) is None for name in WORK_KEY):
        return nothing
    keys = select_aliased(log, {name: (name,) for name in WORK_KEY}, trim=True)
    for name in WORK_KEY:
        keys = keys.where(F.col(name) != "")
    return keys.distinct()
