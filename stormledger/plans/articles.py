"""Articles per county event: match or attach, score, dedup, conform."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormledger.functions.dates import compact_ts
from stormledger.functions.fixed import (
    DEFAULT_LANGUAGE,
    MAX_ARTICLES_PER_EVENT,
    MIN_TITLE_HITS,
    TYPE_SYNONYMS,
)
from stormledger.functions.search import (
    keyword_set,
    place_phrase,
    synonym_query,
    title_hits,
    title_hits_of_each,
)
from stormledger.functions.text import field_fallback, safe_trim
from stormledger.operators.dedup import keep_first_url
from stormledger.operators.filters import enough_hits, not_empty
from stormledger.operators.joins import newest_in_window
from stormledger.operators.numbering import index_rows
from stormledger.operators.phrases import find_phrases
from stormledger.schemas import ARTICLE, ARTICLE_PAYLOAD, SPINE
from stormledger.sinks.writers import write_articles, write_audit
from stormledger.sources.ndjson import land_ndjson
from stormledger.sources.payloads import explode_articles, offered_articles
from stormledger.storage import durable

EVENT_COLUMNS = (
    "disasterNumber",
    "county_fips",
    "state",
    "county",
    "incidentType",
    "window_start",
    "window_end",
    "label",
    "gdelt_query",
    "keywords",
)


OFFERED, SCORE = "_offered", "_score"


def events_from_spine(spine: DataFrame, *keep: str | Column) -> DataFrame:
    """Trimmed events with their search text; events lacking a required field go.

    ``keep`` names further columns to carry, such as a position that orders events.
    """
    return _with_search_values(_queried(spine, *keep))


def _queried(spine: DataFrame, *keep: str | Column) -> DataFrame:
    """Trimmed events with their search text, without what is derived from it."""
    trimmed = spine.select(
        *keep,
        F.col("fema_disaster_number").alias("disasterNumber"),
        safe_trim(F.col("county_fips")).alias("county_fips"),
        safe_trim(F.col("state")).alias("state"),
        safe_trim(F.col("county")).alias("county"),
        safe_trim(field_fallback(F.col("disaster"), F.col("fema_incident_type"))).alias(
            "incidentType"
        ),
        safe_trim(F.col("window_start")).alias("window_start"),
        safe_trim(F.col("window_end")).alias("window_end"),
        safe_trim(F.col("label")).alias("label"),
        safe_trim(F.col("fema_designated_area")).alias("designated"),
    ).where(
        not_empty(
            *[F.col(c) for c in ("window_start", "window_end", "county", "state", "incidentType")]
        )
    )
    query = synonym_query(
        place_phrase(F.col("county"), F.col("state")), F.col("designated"), F.col("incidentType")
    )
    return trimmed.withColumn("gdelt_query", query)


def _with_search_values(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            "keywords": keyword_set(F.col("gdelt_query")),
            "startdatetime": compact_ts(F.col("window_start")),
            "enddatetime": compact_ts(F.col("window_end")),
        }
    )


def attach_payloads(
    events: DataFrame,
    payloads: DataFrame,
    keys: Sequence[str],
    *keep: str,
    columns: Sequence[str] = EVENT_COLUMNS,
    first: int | None = None,
    scored: bool = False,
) -> DataFrame:
    """One row per article of an event's landed payload, event ``columns`` on each.

    Events without a payload, or with an empty one, give no rows. With ``first`` only so many
    articles of each payload are taken; the others, and the list that is not used, stay where
    they are. With ``scored`` the rows carry their title hits in ``SCORE``, counted once.
    """
    offered = payloads.select(*keys, offered_articles(first).alias(OFFERED))
    return attach_offered(events, offered, keys, *keep, columns=columns, scored=scored)


def attach_offered(
    events: DataFrame,
    offered: DataFrame,
    keys: Sequence[str],
    *keep: str,
    columns: Sequence[str] = EVENT_COLUMNS,
    scored: bool = False,
) -> DataFrame:
    """``attach_payloads`` where the articles to take lie in ``OFFERED`` already."""
    words = ["keywords"] if scored else []
    needed = events.select(*dict.fromkeys([*keys, *keep, *columns, *words]))
    joined = needed.join(offered, list(keys))
    hits = {SCORE: title_hits_of_each(F.col("keywords"), F.col(OFFERED)["title"])}
    return explode_articles(
        joined, *keep, *columns, items=F.col(OFFERED), more=hits if scored else None
    )


def match_articles(
    events: DataFrame,
    articles: DataFrame,
    article_id: str = "url",
    seen: str = "seen",
    text: str = "title",
    per_event: int = MAX_ARTICLES_PER_EVENT,
    language: str | None = DEFAULT_LANGUAGE,
    end_of_day: bool = False,
) -> DataFrame:
    """The newest articles of each event, from a local article table.

    Each spine line is an event of its own: lines that share ``event_id`` but not their
    window, place or type are matched apart, and a line that comes twice gives its
    articles twice.

    An article belongs to an event when it was seen from midnight of ``window_start``
    to midnight of ``window_end`` (the start of that day, or with ``end_of_day`` its end), and its text has the
    county's or the designated area's phrase, and one of the type's search words.

    Articles are first tagged with the phrases and words they contain, once for all
    events. After that, event and article meet on equal (place, type) and a time
    interval, and no event meets more than a few times ``per_event`` articles. The tags
    are written down, so the texts are read once.

    ``article_id`` has to be unique. Articles need the payload article columns and
    ``seen``, a timestamp.
    """
    # Numbered and written down, a line keeps its number, and a number is shorter than a digest
    # of the line in all that is shuffled with it.
    events = durable(events.withColumn("_event", F.monotonically_increasing_id()))
    windows = events.withColumns(
        {
            "_start": F.try_to_date("window_start", "yyyy-MM-dd"),
            "_end": F.try_to_date("window_end", "yyyy-MM-dd"),
        }
    )
    placed = windows.withColumn(
        "_place",
        F.explode(
            F.array_distinct(
                F.filter(
                    F.array(place_phrase(F.col("county"), F.col("state")), F.col("designated")),
                    lambda p: p != "",
                )
            )
        ),
    ).withColumn("_type", F.lower("incidentType"))

    wanted = articles
    if language is not None:
        wanted = wanted.where(F.coalesce("language", F.lit(language)) == language)
    tagged = durable(_tag_places_and_types(wanted, [article_id, seen], text, placed))
    ids = ["_place", "_type"]
    spans = placed.select(*ids, "_event", "_start", "_end")
    newest = newest_in_window(
        spans, tagged, ids, "_start", "_end", seen, [article_id], per_event, end_of_day
    )
    # An article may carry both places of an event: it ranks once, and is kept once where the
    # event's rows already lie together.
    newest_first = W.partitionBy("_event").orderBy(F.col(seen).desc(), F.col(article_id))
    ranked = (
        newest.select("_event", article_id, seen)
        .withColumn("rank", F.dense_rank().over(newest_first))
        .where(F.col("rank") <= per_event)
        .distinct()
    )
    # Written down, its size is known: where it is small it is broadcast, and the
    # articles are filtered where they lie instead of being shuffled.
    matched = durable(ranked.withColumn("article_pos", F.col("rank") - 1).drop("rank", seen))
    return (
        wanted.drop(seen)
        .join(matched, article_id)
        .join(events, "_event")
        .drop("_event")
    )


def _tag_places_and_types(
    articles: DataFrame, ids: Sequence[str], text: str, placed: DataFrame
) -> DataFrame:
    """(ids, _place, _type) for every place and type an article's text holds.

    Places and search words are looked for in one pass over the texts. What an article
    holds is listed per article, so neither list grows with the articles.
    """
    known = [(kind, word) for kind, words in TYPE_SYNONYMS.items() for word in words]
    synonyms = articles.sparkSession.createDataFrame(known, "_type string, phrase string")
    types = placed.select("_type").distinct()
    unlisted = types.where(~F.col("_type").isin(list(TYPE_SYNONYMS)))
    type_words = types.join(synonyms, "_type").unionByName(
        unlisted.withColumn("phrase", F.col("_type"))
    )
    roles = type_words.withColumn("_place", F.lit(None).cast("string")).unionByName(
        placed.select("_place").distinct().withColumns(
            {"phrase": F.col("_place"), "_type": F.lit(None).cast("string")}
        )
    )
    roles = durable(roles)
    held = (
        find_phrases(articles, ids, text, roles)
        .join(roles, "phrase")
        .groupBy(*ids)
        .agg(F.collect_set("_place").alias("_places"), F.collect_set("_type").alias("_types"))
    )
    return held.select(*ids, F.explode("_places").alias("_place"), "_types").select(
        *ids, "_place", F.explode("_types").alias("_type")
    )


def score_articles(
    candidates: DataFrame,
    order: Sequence[str],
    min_title_hits: int = MIN_TITLE_HITS,
    language: str = DEFAULT_LANGUAGE,
    columns: Sequence[str] = EVENT_COLUMNS,
) -> DataFrame:
    """The candidates with enough title hits as article rows, ``order`` before their columns.

    ``columns`` are those of the event that the candidates carry. Candidates that have their
    ``SCORE`` need no keywords.
    """
    hits = (
        F.col(SCORE)
        if SCORE in candidates.columns
        else title_hits(F.col("keywords"), F.col("title"))
    )
    scored = candidates.withColumns(
        {
            "url": field_fallback(F.col("url"), F.col("seendateurl")),
            "score": hits.cast("bigint"),
        }
    ).where(not_empty(F.col("title"), F.col("url")) & enough_hits(F.col("score"), min_title_hits))
    return scored.select(
        *order,
        *[c for c in columns if c != "keywords"],
        "title",
        "url",
        field_fallback(F.col("seendate"), F.col("date")).alias("datetime"),
        F.coalesce("sourcecountry", F.lit("")).alias("sourceCountry"),
        F.coalesce("domain", F.lit("")).alias("domain"),
        field_fallback(F.col("language"), F.lit(language)).alias("lang"),
        "score",
        F.lit(f"title_hits>={min_title_hits}").alias("kept_reason"),
    )


def select_articles(
    candidates: DataFrame,
    order: Sequence[str],
    min_title_hits: int = MIN_TITLE_HITS,
    language: str = DEFAULT_LANGUAGE,
) -> DataFrame:
    """Score titles, keep those with enough hits, then one row per URL over all events.

    ``order`` says which copy of a URL is the first: event position, then article
    position. The hit filter comes before the dedup, so a copy that scores too low
    does not shadow a later one.
    """
    scored = score_articles(candidates, order, min_title_hits, language)
    return keep_first_url(scored, "url", *order).select(*ARTICLE.names)


def first_articles(
    events: DataFrame,
    candidates: DataFrame,
    min_title_hits: int = MIN_TITLE_HITS,
    language: str = DEFAULT_LANGUAGE,
) -> DataFrame:
    """``select_articles`` for candidates that carry ``_order`` and ``keywords`` of their event, or
    ``_order`` and their ``SCORE``, in the order of ``_order`` and ``article_pos``, which are kept.

    ``_order`` is unique in ``events``, so the event's other columns are looked up for the rows
    that stay, instead of being sorted and sent with every candidate.
    """
    scored = score_articles(
        candidates, ("_order", "article_pos"), min_title_hits, language, ("keywords",)
    )
    first = keep_first_url(scored, "url", "_order", "article_pos")
    described = events.select("_order", *[c for c in EVENT_COLUMNS if c != "keywords"])
    return first.join(described, "_order").select("_order", "article_pos", *ARTICLE.names)


def ordered_events(spine: DataFrame) -> DataFrame:
    """The spine's events with their place in ``_order``: latest date first, then by number,
    county and their other fields, whatever files and appends the spine lies in."""
    events = _queried(spine, F.col("date").alias("_date"))
    rest = [c for c in EVENT_COLUMNS if c not in ("keywords", *EVENT_KEY)]
    order = [F.col("_date").desc_nulls_last(), *EVENT_KEY, *rest]
    return _with_search_values(index_rows(events, order, "_order").drop("_date"))


EVENT_KEY = ("disasterNumber", "county_fips")
LANDED_PAYLOAD = T.StructType(
    [
        T.StructField("disasterNumber", T.LongType()),
        T.StructField("county_fips", T.StringType()),
        *ARTICLE_PAYLOAD.fields,
    ]
)


def run_articles(
    spark: SparkSession,
    spine_path: str,
    payload_path: str,
    ndjson_path: str,
    csv_path: str,
    per_event: int = MAX_ARTICLES_PER_EVENT,
    min_title_hits: int = MIN_TITLE_HITS,
    language: str = DEFAULT_LANGUAGE,
    bad_root: str | None = None,
    run_id: str | None = None,
) -> dict[str, int]:
    """Article files from spine files and one landed payload per event.

    Events come in one fixed order (see ``ordered_events``); articles in the order of their
    payload (newest first), of which the first ``per_event`` are used. Malformed lines are left
    out on both sides and, with a ``bad_root``, written there.
    Returns the number of candidates and of articles kept, both counted while writing,
    and of malformed lines.
    """
    spine, bad_events = land_ndjson(spark, spine_path, SPINE)
    offered_first = offered_articles(per_event).alias(OFFERED)
    payloads, bad_payloads = land_ndjson(
        spark, payload_path, LANDED_PAYLOAD, *EVENT_KEY, offered_first
    )
    events = ordered_events(spine)
    offered, kept = Observation("offered"), Observation("kept")
    candidates = (
        attach_offered(events, payloads, EVENT_KEY, "_order", columns=[], scored=True)
        .observe(offered, F.count("*").alias("n"))
    )
    selected = (
        first_articles(events, candidates, min_title_hits, language)
        .select(*ARTICLE.names)
        .observe(kept, F.count("*").alias("n"))
    )
    write_articles(selected, ndjson_path, csv_path)
    if bad_root is not None:
        write_audit(bad_events, f"{bad_root}/events", run_id or uuid.uuid4().hex)
        write_audit(bad_payloads, f"{bad_root}/payloads", run_id or uuid.uuid4().hex)
    return {
        "candidates": offered.get["n"],
        "kept": kept.get["n"],
        "malformed_events": bad_events.count(),
        "malformed_payloads": bad_payloads.count(),
    }
