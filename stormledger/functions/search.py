"""Search texts for a county event, and title scoring against them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormledger.functions.arrays import let
from stormledger.functions.fixed import (
    CAPITAL_DISTRICT_NAMES,
    DISASTER_THEMES,
    TYPE_SYNONYMS,
)
from stormledger.functions.text import WHITESPACE_CLASS, strip


def _by_value(key: Column, texts: Mapping[str, str], otherwise: Column) -> Column:
    chain = F.when(F.lit(False), otherwise)
    for value, text in texts.items():
        chain = chain.when(key == value, text)
    return chain.otherwise(otherwise)


def theme_clause(
    disaster: Column, themes: Mapping[str, Sequence[str]] = DISASTER_THEMES
) -> Column:
    """``(theme:A OR theme:B)`` for a known disaster, the word itself otherwise."""
    clauses = {
        name: "(" + " OR ".join(f"theme:{t}" for t in tokens) + ")"
        for name, tokens in themes.items()
        if tokens
    }
    return _by_value(disaster, clauses, disaster)


def location_clause(county: Column, state: Column) -> Column:
    """``location:"X County, State, US"``; names that already carry a suffix keep theirs."""
    name = strip(county)
    lowered = F.lower(name)
    keeps_name = (
        lowered.contains("parish")
        | lowered.contains("city and borough")
        | lowered.endswith(" city")
        | (lowered == "city")
        | lowered.contains("borough")
        | lowered.contains("census area")
        | F.lower(strip(state)).isin(list(CAPITAL_DISTRICT_NAMES))
        | lowered.endswith(" county")
    )
    label = F.when(keeps_name, name).otherwise(F.concat(name, F.lit(" County")))
    return F.concat(F.lit('location:"'), label, F.lit(", "), state, F.lit(', US"'))


def place_phrase(county: Column, state: Column) -> Column:
    """The place an event is searched by: ``X County, State``."""
    return F.concat(county, F.lit(" County, "), state)


def synonym_query(
    place: Column,
    designated: Column,
    incident_type: Column,
    synonyms: Mapping[str, Sequence[str]] = TYPE_SYNONYMS,
) -> Column:
    """``("place" OR "designated") AND ("word" OR ...)``; empty places are left out."""

    def quoted(text: Column) -> Column:
        bare = F.replace(text, F.lit('"'), F.lit(""))
        return F.when(bare != "", F.concat(F.lit('"'), bare, F.lit('"')))

    places = F.concat_ws(" OR ", quoted(place), quoted(designated))
    places = F.when(places == "", '""').otherwise(places)
    kind = F.lower(incident_type)
    known = {name: " OR ".join(f'"{w}"' for w in words) for name, words in synonyms.items()}
    words = _by_value(kind, known, F.concat(F.lit('"'), kind, F.lit('"')))
    return F.concat(F.lit("("), places, F.lit(") AND ("), words, F.lit(")"))


def keyword_set(query: Column) -> Column:
    """Distinct lower-case words of a query text, longer than two characters.

    ``AND`` and ``OR`` are dropped wherever the letters occur, also inside words, and
    commas stay on their word. Both decide scores, so both are kept.
    """
    bare = query
    for dropped in ("(", ")", "AND", "OR"):
        bare = F.replace(bare, F.lit(dropped), F.lit(""))
    words = F.transform(
        F.split(bare, "(?U)" + WHITESPACE_CLASS + "+"), lambda w: F.btrim(w, F.lit('"'))
    )
    long_words = F.filter(words, lambda w: F.length(w) > 2)
    return F.array_distinct(F.transform(long_words, F.lower))


def title_hits(keywords: Column, title: Column) -> Column:
    """Number of keywords that occur as substrings of the lower-case title."""
    return let(
        F.lower(title),
        lambda lowered: F.size(F.filter(keywords, lambda k: F.contains(lowered, k))),
    )


def title_hits_of_each(keywords: Column, titles: Column) -> Column:
    """``title_hits`` of every title of a list. The words are taken out of their row once for all
    titles, and each title is lowered once for all words."""
    lowered = F.transform(titles, F.lower)

    def counted(words: Column) -> Column:
        return F.transform(
            lowered, lambda title: F.size(F.filter(words, lambda k: F.contains(title, k)))
        )

    return let(F.transform(keywords, lambda k: k), counted)
