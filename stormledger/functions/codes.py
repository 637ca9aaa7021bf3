"""County code expressions. Codes are unsigned digit strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormledger.functions.text import nullif_empty, safe_trim


def zero_pad(code: Column, width: int) -> Column:
    """Left-pad with zeros; longer codes stay whole (``lpad`` alone would cut them)."""
    return F.when(F.length(code) < width, F.lpad(code, width, "0")).otherwise(code)


def compose_geoid(state: Column, county: Column) -> Column:
    return F.concat(zero_pad(state, 2), zero_pad(county, 3))


def valid_code(geoid: Column) -> Column:
    """Both codes of a composed geoid are digits only.

    Empty codes pad to zeros and pass; they then find no county.
    """
    return geoid.rlike("^[0-9]+$")


def _digits(text: Column) -> Column:
    return F.regexp_replace(safe_trim(text), r"(?U)\D", "")


def fips_key(
    geoid: Column | None = None, state: Column | None = None, county: Column | None = None
) -> Column:
    """Five-digit key of a county row: its geoid if filled, else state and county code.

    Pass ``None`` for a column the file does not have. A row without a single digit
    has no key: NULL, not "00000", so that it can be set aside.
    """
    options = []
    if geoid is not None:
        filled = F.coalesce(geoid, F.lit("")) != ""
        options.append((filled, zero_pad(nullif_empty(_digits(geoid)), 5)))
    if state is not None and county is not None:
        some_digit = F.concat(_digits(state), _digits(county)) != ""
        options.append((some_digit, compose_geoid(_digits(state), _digits(county))))
    if not options:
        raise ValueError("fips_key needs a geoid column, or a state and a county code column")
    key, *rest = options
    chain = F.when(*key)
    for option in rest:
        chain = chain.when(*option)
    return chain
