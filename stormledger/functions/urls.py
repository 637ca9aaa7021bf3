"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormledger.functions.text import field_fallback, strip


def url_base(url: Column) -> Column:
    """URL up to its first question mark; fragment and case stay."""
    return F.substring_index(url, "?", 1)


def source_or_host(source: Column, url: Column) -> Column:
    """Source name, else the host part with port and user, else empty."""
    return field_fallback(source, F.regexp_extract(url, "https?://([^/]+)", 1))


def encode_query(query: Column) -> Column:
    """Form-encode as ``urllib.parse.quote_plus`` does: ``~`` stays and ``*`` is escaped."""
    encoded = F.url_encode(strip(query))
    encoded = F.replace(encoded, F.lit("%7E"), F.lit("~"))
    return F.replace(encoded, F.lit("*"), F.lit("%2A"))
