"""One JSON object per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormledger.functions.arrays import let
from stormledger.functions.text import is_blank, strip
from stormledger.storage import durable

CORRUPT = "_corrupt_record"


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of a file that must be clean: a malformed line fails the job, blank lines
    give no row."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def is_json_object(text: Column) -> Column:
    """True for exactly one JSON object, with nothing but blanks around it.

    Spark's parser stops at the end of a value. Inside an array with a known last entry,
    trailing text shows: it breaks the array, or changes its entries.
    """
    entries = F.from_json(
        F.concat(F.lit("["), text, F.lit(",0]")), "array<string>", {"allowSingleQuotes": "false"}
    )
    whole = (F.size(entries) == 2) & (F.get(entries, F.lit(1)) == "0")
    return F.coalesce(whole & strip(text).startswith("{"), F.lit(False))


#: A field that no record has, of the object that has to follow a record in an array.
_LAST = "\\u0001last"


def parsed_line(text: Column, schema: T.StructType) -> Column:
    """struct<good, row> of a line that should be one JSON object; ``row`` is NULL if it is not.

    One parse says both: the line is read as the first of two entries of an array, the second
    of which is known. What is no object, or more than one, breaks the array or shifts that
    entry. Fields are read as text first and cast to their type then, so a number written as
    a string is read too; a value that does not fit its type is NULL and the row stays.
    """

    def checked(found: Column) -> Column:
        good = _is_whole(found, F.contains(text, F.lit(_LAST)))
        row = F.struct(*_fields(found, schema))
        return F.struct(good.alias("good"), F.when(good, row).alias("row"))

    return let(_entries(text, schema), checked)


_NESTED = (T.ArrayType, T.MapType, T.StructType)
_LAST_NAME = _LAST.encode().decode("unicode_escape")


def _entries(text: Column, schema: T.StructType) -> Column:
    """The line and the known entry after it, with fields as text."""
    as_text = [
        f if isinstance(f.dataType, _NESTED) else T.StructField(f.name, T.StringType())
        for f in schema
    ]
    entry = T.ArrayType(T.StructType([*as_text, T.StructField(_LAST_NAME, T.StringType())]))
    return F.from_json(
        F.concat(F.lit("["), text, F.lit(f',{{"{_LAST}":"0"}}]')),
        entry,
        {"allowSingleQuotes": "false"},
    )


def _is_whole(found: Column, marked: Column) -> Column:
    """Whether ``found`` are one object and the known entry. ``marked`` lines name that entry."""
    whole = (
        (F.size(found) == 2)
        & (F.get(found, F.lit(1))[_LAST_NAME] == "0")
        & F.get(found, F.lit(0)).isNotNull()
    )
    return F.coalesce(whole & ~marked, F.lit(False))


def _fields(found: Column, schema: T.StructType) -> list[Column]:
    record = F.get(found, F.lit(0))
    return [
        record[f.name].alias(f.name)
        if isinstance(f.dataType, (*_NESTED, T.StringType))
        else record[f.name].try_cast(f.dataType).alias(f.name)
        for f in schema
    ]


def parse_lines(lines: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """Parse a column of JSON lines; a malformed line keeps its text in ``CORRUPT``.

    Other columns, such as the line index, stay next to the fields. Blank lines are dropped.
    A line is parsed once, also where the result is filtered: the parsed line is exploded, as
    a list of one, and filters do not move below that. Fields are taken from it as it is, without
    a copy of its lists.
    """
    others = [c for c in lines.columns if c != text]
    line = F.struct(
        _entries(F.col(text), schema).alias("found"),
        F.contains(F.col(text), F.lit(_LAST)).alias("marked"),
    )
    good = _is_whole(F.col("_line.found"), F.col("_line.marked"))
    return (
        lines.where(~is_blank(F.col(text)))
        .select(*others, F.col(text).alias("_text"), F.explode(F.array(line)).alias("_line"))
        .select(
            *others,
            *[
                F.when(good, field).alias(f.name)
                for field, f in zip(_fields(F.col("_line.found"), schema), schema, strict=True)
            ],
            F.when(~good, F.col("_text")).alias(CORRUPT),
        )
    )


def read_ndjson_tolerant(
    spark: SparkSession, path: str, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed lines), each from a parse of its own."""
    return _parted(parse_lines(spark.read.text(path), schema))


def land_ndjson(
    spark: SparkSession, path: str, schema: T.StructType, *columns: Column | str
) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed lines) of one parse, whose rows are kept in the shared folder.

    For jobs that use the rows and also count or keep the malformed lines: these are read
    back by their column alone. With ``columns`` the rows are kept as these, made while the lines
    are parsed, for jobs that need only a part of long records.
    """
    rows = parse_lines(spark.read.text(path), schema)
    return _parted(durable(rows.select(*columns, CORRUPT) if columns else rows))


def _parted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = rows.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)
    return good, bad
