"""Landed service responses: JSON pages, header-row JSON and CSV text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormledger.functions.arrays import let
from stormledger.functions.fixed import PAYLOAD_MARKER
from stormledger.schemas import DECLARATION_ARRAY, DECLARATION_PAGE

# A quote sign opens a quoted stretch only where a cell begins; anywhere else it is an
# ordinary character. All repetitions are possessive: linear time, no recursion.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+(?:"|\z)'
_RECORD = rf'(?:(?<![^,\n]){_QUOTED}|[^"\n]++|")++'
_CELL = rf",({_QUOTED}[^,]*+|[^,]*+)"
_CELL_PARTS = r'^"([^"]*+(?:""[^"]*+)*+)(?:"|\z)'


def explode_structs(df: DataFrame, array: Column, *keep: str, computed: bool = False) -> DataFrame:
    """One row per struct in ``array``, its fields next to the kept columns.

    Ahead of a plain ``explode`` Spark filters on the size of the array. Where the array is
    ``computed`` from other columns that filter computes it anew, so rows without structs are
    dropped after the explosion then.
    """
    if not computed:
        return df.select(*keep, F.explode(array).alias("_item")).select(*keep, "_item.*")
    exploded = df.select(*keep, F.posexplode_outer(array).alias("_nth", "_item"))
    return exploded.where(F.col("_nth").isNotNull()).select(*keep, "_item.*")


def read_declaration_pages(
    spark: SparkSession, path: str, multi_line: bool = True
) -> DataFrame:
    """Declarations of landed page files, each an object holding one array of rows.

    Pages hold a thousand rows or so; with one page per line, ``multi_line=False``
    lets Spark split the files.
    """
    pages = spark.read.schema(DECLARATION_PAGE).option("multiLine", multi_line).json(path)
    return explode_structs(pages, F.col(DECLARATION_ARRAY))


def header_row_json(
    df: DataFrame, payload: Column, names: Sequence[str], *keep: str
) -> DataFrame:
    """Rows of a JSON array of arrays whose first array is a header.

    The header is skipped; columns are taken by position. ``row_pos`` is the place of
    the row in its payload, from 1.
    """
    rows = F.from_json(payload, T.ArrayType(T.ArrayType(T.StringType())))
    exploded = df.select(*keep, F.posexplode(rows).alias("row_pos", "_cells")).where("row_pos > 0")
    return exploded.select(
        *keep, "row_pos", *[F.get("_cells", F.lit(i)).alias(name) for i, name in enumerate(names)]
    )


def offered_articles(first: int | None = None) -> Column:
    """``articles``, or ``timeline`` where that is missing or empty; the ``first`` ones of it."""
    filled = F.coalesce(F.size("articles"), F.lit(0)) > 0
    items = F.when(filled, F.col("articles")).otherwise(F.col("timeline"))
    return items if first is None else F.slice(items, 1, first)


def explode_articles(
    df: DataFrame,
    *keep: str,
    items: Column | None = None,
    more: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per article of ``items``, by default all that a payload offers.

    ``article_pos`` is the place of the article in its payload. ``more`` names lists with a value
    for each of the ``items``, which become columns. Such a value is computed once, where a filter
    on a column made later would compute it again.
    """
    items = offered_articles() if items is None else items
    if not more:
        return df.select(*keep, F.posexplode(items).alias("article_pos", "_item")).select(
            *keep, "article_pos", "_item.*"
        )
    made = {f"_more_{name}": values for name, values in more.items()}
    return (
        df.withColumns({"_item": items, **made})
        .select(*keep, F.posexplode(F.arrays_zip("_item", *made)).alias("article_pos", "_both"))
        .select(
            *keep,
            "article_pos",
            "_both._item.*",
            *[F.col(f"_both._more_{name}").alias(name) for name in more],
        )
    )


def _unquote(cell: Column) -> Column:
    """The quoted stretch without its quotes, and what follows it up to the comma."""
    inner = F.replace(F.regexp_extract(cell, _CELL_PARTS, 1), F.lit('""'), F.lit('"'))
    after = F.regexp_replace(cell, _CELL_PARTS, "")
    return F.when(cell.startswith('"'), F.concat(inner, after)).otherwise(cell)


def csv_cells(text: Column) -> Column:
    """array<array<string>>: the records of a CSV text and their cells, header first.

    Reads what Python's csv module reads: quoted cells may hold commas, doubled quotes
    and line breaks as they are; lines end in LF or CRLF; empty lines are no records.
    """
    records = F.filter(
        F.transform(
            F.regexp_extract_all(text, F.lit(_RECORD), F.lit(0)),
            lambda r: F.regexp_replace(r, r"\r\z", ""),
        ),
        lambda r: r != "",
    )
    return F.transform(
        records,
        lambda r: F.transform(
            F.regexp_extract_all(F.concat(F.lit(","), r), F.lit(_CELL), F.lit(1)), _unquote
        ),
    )


def csv_payload_array(text: Column, fields: Sequence[str]) -> Column:
    """array<struct<article_pos, fields>> of a CSV text, cells found by its own header.

    Texts without the marker give an empty array; cells that a row or the header lacks
    are NULL.
    """

    def rows(cells: Column) -> Column:
        header = F.get(cells, F.lit(0))
        # array_position is 0 for an absent name; get() then reads index -1, NULL.
        places = F.struct(*[F.array_position(header, f).cast("int").alias(f) for f in fields])
        return let(
            places,
            lambda at: F.transform(
                F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0))),
                lambda row, i: F.struct(
                    i.alias("article_pos"), *[F.get(row, at[f] - 1).alias(f) for f in fields]
                ),
            ),
        )

    kind = "array<struct<article_pos:int," + ",".join(f"`{f}`:string" for f in fields) + ">>"
    return F.when(usable_payload(text), let(csv_cells(text), rows)).otherwise(
        F.array().cast(kind)
    )


def usable_payload(text: Column, status: Column | None = None, min_length: int = 0) -> Column:
    """True for a payload that holds article rows.

    A fetch also has to have answered 200 with more than 100 characters: pass its
    status and ``min_length=100``.
    """
    usable = F.coalesce(text, F.lit("")).contains(PAYLOAD_MARKER)
    if min_length:
        usable = usable & (F.length(text) > min_length)
    if status is not None:
        usable = usable & (status == 200)
    return usable


def csv_payload_rows(
    df: DataFrame, text: str, fields: Sequence[str], *keep: str
) -> DataFrame:
    """Rows of CSV texts held in a column; ``article_pos`` counts a text's rows from 0."""
    return explode_structs(
        df.select(*keep, csv_payload_array(F.col(text), fields).alias("_rows")),
        F.col("_rows"),
        *keep,
        computed=True,
    )
