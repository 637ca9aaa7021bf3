"""JSON objects as text: changed in one place, kept as written everywhere else."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormledger.functions.arrays import let
from stormledger.functions.text import strip

_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_TOKEN = rf'(?s){_STRING}|[{{}}\[\],:]|[^"{{}}\[\],:]++'
_NAME = rf"(?s)^\s*+({_STRING})"


def members(record: Column) -> Column:
    """The members of a JSON object as texts, in order, without the commas between them.

    One pass over the tokens keeps the depth of nesting; the object's own commas and braces
    are those at depth one.
    """

    def step(state: Column, token: Column) -> Column:
        opens, closes = token.isin("{", "["), token.isin("}", "]")
        outer = (token == ",") & (state["depth"] == 1)
        border = outer | (opens & (state["depth"] == 0)) | (closes & (state["depth"] == 1))
        return F.struct(
            (state["depth"] + opens.cast("int") - closes.cast("int")).alias("depth"),
            (state["at"] + 1).alias("at"),
            F.when(border, F.concat(state["cuts"], F.array(state["at"])))
            .otherwise(state["cuts"])
            .alias("cuts"),
        )

    def between(tokens: Column) -> Column:
        start = F.struct(
            F.lit(0).alias("depth"),
            F.lit(1).alias("at"),
            F.array().cast("array<int>").alias("cuts"),
        )
        return let(
            F.aggregate(tokens, start, step)["cuts"],
            lambda cuts: F.transform(
                F.slice(cuts, F.lit(1), F.size(cuts) - 1),
                lambda cut, i: F.array_join(
                    F.slice(tokens, cut + 1, F.get(cuts, i + 1) - cut - 1), ""
                ),
            ),
        )

    texts = let(F.regexp_extract_all(record, F.lit(_TOKEN), F.lit(0)), between)
    return F.filter(texts, lambda m: strip(m) != "")


def _is_named(member: Column, name: str) -> Column:
    """Whether a member has this name, however its letters are escaped."""
    spelled = F.concat(F.lit("["), F.regexp_extract(member, _NAME, 1), F.lit("]"))
    return F.coalesce(F.get(F.from_json(spelled, "array<string>"), F.lit(0)) == name, F.lit(False))


def _spelled(name: str, value: Column) -> Column:
    text = F.regexp_replace(F.to_json(F.struct(value.alias("v"))), r'(?s)\A\{"v":(.*)\}\z', "$1")
    return F.concat(F.lit(f'"{name}": '), text)


def _appended(record: Column, field: Column) -> Column:
    opened = F.regexp_replace(record, r"\s*+\}\s*+$", "")
    comma = F.when(F.rlike(opened, F.lit(r"^\s*\{\s*$")), "").otherwise(", ")
    return F.concat(opened, comma, field, F.lit("}"))


def _replaced(record: Column, name: str, field: Column) -> Column:
    def joined(parts: Column) -> Column:
        own = F.transform(parts, lambda m: _is_named(m, name))
        return let(
            F.struct(parts.alias("parts"), F.array_position(own, True).alias("first"), own.alias("own")),
            lambda x: F.array_join(
                F.filter(
                    F.transform(
                        x["parts"],
                        lambda m, i: F.when(~F.get(x["own"], i), m).when(
                            i + 1 == x["first"], F.concat(F.regexp_extract(m, r"^\s*+", 0), field)
                        ),
                    ),
                    lambda m: m.isNotNull(),
                ),
                ",",
            ),
        )

    return F.concat(F.lit("{"), let(members(record), joined), F.lit("}"))


def with_field(record: Column, name: str, value: Column) -> Column:
    """A JSON object (as text) whose top-level field ``name`` is ``value``, a string.

    A field of that name is replaced where it first stands, whatever its value was, and its
    repeats go; otherwise the field comes last. Fields of that name further inside stay. Only
    objects that may have the field are taken apart.
    """
    field = _spelled(name, value)
    may_have = F.contains(record, F.lit(name)) | F.contains(record, F.lit("\\u"))
    has = F.when(may_have, F.array_contains(F.json_object_keys(record), name))
    return F.when(F.coalesce(has, F.lit(False)), _replaced(record, name, field)).otherwise(
        _appended(record, field)
    )
