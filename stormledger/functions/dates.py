"""Date expressions. Only calendar dates are kept; a time zone never shifts a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormledger.functions.fixed import POST_DAYS, PRE_DAYS
from stormledger.functions.text import nullif_empty, strip

_DATE = r"(?!0000)\d{4}-\d{2}-\d{2}"
_HOUR = r"(?:[01]\d|2[0-3])"
_SIXTY = r"[0-5]\d"
_CLOCK = rf"{_HOUR}(?::{_SIXTY}(?::{_SIXTY}(?:,\d+)?)?|{_SIXTY}(?:{_SIXTY}(?:,\d+)?)?)?"
_OFFSET = rf"(?:Z|[+-]{_HOUR}(?::{_SIXTY}(?::{_SIXTY})?|{_SIXTY}(?:{_SIXTY})?)?)?"
# A bare date; or at least 19 characters with a "T" among them, where the clock time
# may carry an offset and whatever follows the first dot is ignored.
DATE_SHAPE = (
    rf"(?s)\A({_DATE})(?:\z|(?=.{{9}})(?=.*T)(?:T{_CLOCK}{_OFFSET})?(?:\..*)?\z)"
)


def iso_prefix(text: Column) -> Column:
    """First ten characters, not validated; empty gives NULL."""
    return F.substring(nullif_empty(text), 1, 10)


def parse_date_lenient(text: Column) -> Column:
    """ISO date or ISO instant to its own calendar date; anything else to NULL.

    An instant needs 19 characters and a ``T``; its fraction is cut at the first dot.
    A blank between date and time, a shorter clock time, single-digit months and
    impossible dates are rejected.
    """
    day = F.regexp_extract(strip(text), DATE_SHAPE, 1)
    return day.try_cast("date")


def event_window(
    begin: Column,
    end: Column,
    declared: Column,
    pre_days: int = PRE_DAYS,
    post_days: int = POST_DAYS,
) -> tuple[Column, Column]:
    """Padded window of an incident, from parsed dates.

    Begin and end fall back to the declaration date each on its own. Nothing forces
    start <= end. A side without any date is NULL.
    """
    return (
        F.date_sub(F.coalesce(begin, declared), pre_days),
        F.date_add(F.coalesce(end, declared), post_days),
    )


def iso_text(day: Column) -> Column:
    return day.cast("date").cast("string")


def ymd8_to_iso(text: Column) -> Column:
    """Eight leading digits as YYYY-MM-DD without a calendar check, else empty."""
    return F.when(
        text.rlike(r"(?U)\A\d{8}"),
        F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)),
    ).otherwise("")


def compact_ts(iso_date: Column) -> Column:
    """YYYY-MM-DD to the compact midnight stamp YYYYMMDD000000."""
    return F.concat(F.replace(iso_date, F.lit("-"), F.lit("")), F.lit("000000"))
