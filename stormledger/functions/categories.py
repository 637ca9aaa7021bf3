"""Incident labels and event captions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormledger.functions.fixed import (
    CATEGORY_BY_LABEL,
    CATEGORY_BY_SUBSTRING,
    DEFAULT_CATEGORY,
)
from stormledger.functions.text import nullif_empty, strip


def normalize_category(
    label: Column,
    exact: Mapping[str, str] = CATEGORY_BY_LABEL,
    substrings: Sequence[tuple[str, str]] = CATEGORY_BY_SUBSTRING,
    default: str = DEFAULT_CATEGORY,
) -> Column:
    """Category of an incident label; NULL when the label is NULL or empty."""
    key = F.lower(strip(label))
    labels_of: dict[str, list[str]] = {}
    for known, category in exact.items():
        labels_of.setdefault(category, []).append(known)
    # Only a label without any character has no category; one of white space takes the
    # default. Every condition reads the key, so that Spark computes it once per row.
    no_key = F.coalesce(key == "", F.lit(True))
    chain = F.when(no_key & (F.coalesce(label, F.lit("")) == ""), F.lit(None))
    for category, known in labels_of.items():
        chain = chain.when(key.isin(known), category)
    for part, category in substrings:
        chain = chain.when(key.contains(part), category)
    return chain.otherwise(default)


def category_or_label(label: Column, **options) -> Column:
    """Category as written to records: the empty string for a missing label."""
    return F.coalesce(normalize_category(label, **options), F.lower(F.coalesce(label, F.lit(""))))


def is_default_category(
    label: Column,
    exact: Mapping[str, str] = CATEGORY_BY_LABEL,
    substrings: Sequence[tuple[str, str]] = CATEGORY_BY_SUBSTRING,
) -> Column:
    """True where only the default applied, so that swept-in labels can be counted."""
    return normalize_category(label, exact, substrings, default="") == ""


def event_label(county: Column, state: Column, incident_type: Column) -> Column:
    """Caption "Travis, Texas — Flood"; "Disaster" stands in for a missing type."""
    kind = F.coalesce(nullif_empty(incident_type), F.lit("Disaster"))
    return F.concat(county, F.lit(", "), state, F.lit(" — "), kind)
