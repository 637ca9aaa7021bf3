"""Predicates. Each returns a Column, so that Catalyst can push it into the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormledger.functions.codes import valid_code
from stormledger.functions.fixed import MIN_TITLE_HITS, START_DATE
from stormledger.functions.text import safe_trim

# The skip reasons as logged.
NO_DATES = "no_dates"
BAD_FIPS = "bad_fips"
NOT_MAPPED = "fips_not_in_county_map"
KEPT = ""


def declaration_filter(
    declared: Column,
    state: Column | None = None,
    incident_type: Column | None = None,
    start: str = START_DATE,
    end: str | None = None,
    state_code: str | None = None,
    types: str | None = None,
) -> Column:
    """Declared from ``start`` through the whole of day ``end``, in a state, of given types.

    ``types`` is a comma list compared by exact case. ``declared`` may be an ISO string
    or a date type: the end bound is "before the next day", which orders the same way
    for both and is pushed down.
    """
    condition = declared >= F.lit(start)
    if end is not None:
        next_day = dt.date.fromisoformat(end) + dt.timedelta(days=1)
        condition = condition & (declared < F.lit(next_day.isoformat()))
    if state_code:
        condition = condition & (state == state_code.upper())
    wanted = [t.strip() for t in (types or "").split(",") if t.strip()]
    if wanted:
        condition = condition & incident_type.isin(wanted)
    return condition


def has_window(window_start: Column, window_end: Column) -> Column:
    """Enriched spine: both window ends could be dated, if only from incident dates."""
    return window_start.isNotNull() & window_end.isNotNull()


def has_declaration_date(declared: Column) -> Column:
    """Basic spine: a declaration date is there."""
    return F.coalesce(declared, F.lit("")) != ""


def skip_reason(dated: Column, geoid: Column, mapped: Column) -> Column:
    """Why a declaration is skipped, first reason wins; empty for a kept one."""
    return (
        F.when(~dated, NO_DATES)
        .when(~valid_code(geoid), BAD_FIPS)
        .when(~mapped, NOT_MAPPED)
        .otherwise(KEPT)
    )


def required_fields(*fields: Column) -> Column:
    """None of the fields is NULL, empty or blank."""
    condition = F.lit(True)
    for field in fields:
        condition = condition & (safe_trim(field) != "")
    return condition


def not_empty(*fields: Column) -> Column:
    """None of the fields is NULL or empty; blanks count as content."""
    condition = F.lit(True)
    for field in fields:
        condition = condition & (F.coalesce(field, F.lit("")) != "")
    return condition


def enough_hits(score: Column, minimum: int = MIN_TITLE_HITS) -> Column:
    return score >= minimum
