"""The jobs, end to end on small landed files."""

from __future__ import annotations

import csv
import datetime as dt
import hashlib
import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from stormledger.functions.fixed import DISASTERS, TYPE_SYNONYMS
from stormledger.operators.numbering import index_rows
from stormledger.plans import articles, counties, crawl, keys, spine
from stormledger.schemas import ARTICLE, ARTICLE_PAYLOAD, DECLARATION, PROGRESS_COLUMNS, SPINE
from stormledger.sinks import writers
from stormledger.sources import ndjson, payloads, tabular
from stormledger.storage import durable

STATES = [["NAME", "state"], ["Texas", "48"], ["California", "6"], ["Alaska", "02"]]
COUNTIES = {
    "48": [["NAME", "state", "county"], ["Travis County, Texas", "48", "453"], ["Travis again, Texas", "48", "453"]],
    "06": [["NAME", "state", "county"], ["Kern County, California", "6", "29"]],
}


@pytest.fixture
def county_files(spark, tmp_path):
    states = counties.read_states(spark.createDataFrame([(json.dumps(STATES),)], "value string"))
    landed = spark.createDataFrame(
        [(k, json.dumps(v)) for k, v in COUNTIES.items()], "state_fips string, value string"
    )
    table = counties.county_dimension(states, counties.read_state_counties(landed))
    counties.write_counties(table, str(tmp_path / "csv"), str(tmp_path / "json"))
    return tmp_path


def test_county_dimension(spark, county_files):
    rows = tabular.read_csv(spark, str(county_files / "csv")).collect()
    assert [tuple(r) for r in rows] == [
        ("California", "06", "Kern County", "029", "06029", "Kern"),
        ("Texas", "48", "Travis County", "453", "48453", "Travis"),
    ]
    [part] = (county_files / "json").glob("part-*.txt")
    assert [r["county_geoid"] for r in json.loads(part.read_text())] == ["06029", "48453"]


def test_county_map_last_row_wins_and_unkeyed_rows_are_set_aside(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        "state,county,county_geoid,state_fips,county_fips\n"
        "Texas,Old,48453,,\nTexas,New,US48453,,\nOhio,ByCodes,,39,1\nNowhere,NoCode,,,\n"
    )
    read = tabular.read_counties(spark, str(tmp_path / "c.csv"))
    assert {tuple(r) for r in counties.county_map(read).collect()} == {
        ("48453", "Texas", "New"), ("39001", "Ohio", "ByCodes"),
    }
    assert [r.county_name_clean for r in counties.unkeyed_counties(read).collect()] == ["NoCode"]


def declaration(number, **given):
    row = dict.fromkeys(DECLARATION.names, None)
    row |= {"declarationDate": "2024-02-01T00:00:00.000Z", "incidentType": "Flood", "state": "TX",
            "fipsStateCode": "48", "fipsCountyCode": "453", "disasterNumber": number}
    return row | given


DECLARED = [
    declaration(1, incidentBeginDate="2024-01-10T00:00:00.000Z", incidentEndDate="2024-01-12T00:00:00.000Z",
                declarationType="DR", declarationTitle="RAIN", designatedArea="Travis (County)"),
    declaration(2, declarationDate=None, fipsCountyCode="0A1"),
    declaration(3, fipsCountyCode="0A1"),
    declaration(4, fipsCountyCode="000"),
    declaration(5, fipsStateCode="", fipsCountyCode=""),
    declaration(6, declarationDate="", incidentBeginDate="2024-01-10", incidentEndDate="2024-01-10",
                incidentType="", fipsStateCode="6", fipsCountyCode="29"),
    declaration(7, incidentType=None),
]


@pytest.fixture
def classified(spark, county_files):
    (county_files / "pages").mkdir()
    for i in range(0, len(DECLARED), 3):
        page = {"DisasterDeclarationsSummaries": DECLARED[i : i + 3]}
        (county_files / "pages" / f"{i}.json").write_text(json.dumps(page, indent=1))
    declared = payloads.read_declaration_pages(spark, str(county_files / "pages"))
    known = counties.county_map(tabular.read_counties(spark, str(county_files / "csv")))
    return {by: spine.classify(declared, known, dated_by=by) for by in (spine.WINDOWED, spine.DECLARED)}


def test_spine_and_log(spark, classified, tmp_path):
    counts = spine.run_spine(
        classified[spine.WINDOWED], str(tmp_path / "spine"), str(tmp_path / "audit"), "first"
    )
    by_reason = {r.skip_reason: r.n for r in counts.collect()}
    assert by_reason == {"": 3, "no_dates": 1, "bad_fips": 1, "fips_not_in_county_map": 2}
    assert sum(by_reason.values()) == len(DECLARED)

    rows = {r.fema_disaster_number: r for r in ndjson.read_ndjson(spark, str(tmp_path / "spine"), SPINE).collect()}
    assert rows.keys() == {1, 6, 7}
    assert tuple(rows[1]) == (
        "Texas", "Travis", "48453", "2024-02-01", "2024-01-10", "2024-01-12", "2024-01-03", "2024-01-26",
        "flood", "Flood", "DR", "RAIN", "Travis (County)", 1, "Travis, Texas — Flood", "FEMA",
    )
    assert (rows[6].date, rows[6].disaster, rows[6].label) == (None, "", "Kern, California — Disaster")
    assert rows[7].incident_begin is None and rows[7].window_start == "2024-01-25"

    log = spark.read.parquet(str(tmp_path / "audit" / "log")).drop("run_id").collect()
    shown = {r.disasterNumber: tuple(r)[1:6] + tuple(r)[7:] for r in log}
    assert shown[2] == ("TX", "", "", "Flood", "", "", "", "no_dates", "TX")
    assert shown[3] == ("TX", "", "", "Flood", "flood", "2024-01-25", "2024-02-15", "bad_fips", "TX")
    assert shown[4][:3] == ("TX", "48000", "") and shown[5][1] == "00000"
    assert shown[1] == ("Texas", "48453", "Travis", "Flood", "flood", "2024-01-03", "2024-01-26", "", "TX")


def test_basic_spine_goes_by_declaration_date(classified):
    basic = spine.spine_basic(classified[spine.DECLARED]).collect()
    assert {r.fema_disaster_number for r in basic} == {1, 7}
    assert len(basic[0]) == 8


def test_select_declarations(spark):
    rows = [declaration(i, declarationDate=f"20{10 + i:02d}-01-01T00:00:00.000Z") for i in range(10)]
    df = spark.createDataFrame([tuple(r[n] for n in DECLARATION.names) for r in rows], DECLARATION)
    assert {r.disasterNumber for r in spine.select_declarations(df).collect()} == {5, 6, 7, 8, 9}
    newest = spine.select_declarations(df, max_pages=2, page_size=2, end="2018-12-31").collect()
    assert [r.disasterNumber for r in newest] == [8, 7, 6, 5]


def event(number, county, kind, start="2024-01-03", end="2024-01-26", designated="", state="Texas"):
    row = dict.fromkeys(SPINE.names, "")
    row |= {"state": state, "county": county, "county_fips": "48453", "window_start": start, "window_end": end,
            "disaster": kind, "fema_incident_type": kind, "fema_disaster_number": number, "label": " L ",
            "fema_designated_area": designated}
    return tuple(row[n] for n in SPINE.names)


def article(title, url, **given):
    row = dict.fromkeys(["title", "url", "seendateurl", "seendate", "date", "sourcecountry", "domain", "language"])
    return tuple((row | {"title": title, "url": url} | given).values())


def test_payload_articles_to_keyed_files(spark, tmp_path):
    """Score, filter before dedup, keep-first over events, dual sink, keys."""
    rows = [event(1, "Travis", "flood"), event(2, "Travis", "flood"), event(3, " ", "flood"), event(4, "Bexar", "")]
    events = articles.events_from_spine(spark.createDataFrame(rows, SPINE))
    assert {r.disasterNumber for r in events.collect()} == {1, 2}
    assert events.first().startdatetime == "20240103000000"
    landed = [
        (1, [article("No match here", "http://h/a?1"), article("Flood, in TEXAS", "http://h/b?1", seendate="s", language="Spanish"),
             article("", "http://h/none"), article("flood", None, seendateurl="http://h/c", date="d")], None),
        (2, None, [article("Texas flood", "http://h/a?2"), article("flooding", "http://h/b?2")]),
    ]
    schema = f"disasterNumber bigint, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in ARTICLE_PAYLOAD)}"
    candidates = articles.attach_payloads(events, spark.createDataFrame(landed, schema), ["disasterNumber"])
    kept = articles.select_articles(
        candidates.withColumn("event_pos", F.col("disasterNumber")), ["event_pos", "article_pos"]
    )
    assert kept.columns == ARTICLE.names
    got = {r.url: r for r in kept.collect()}
    assert got.keys() == {"http://h/b?1", "http://h/c", "http://h/a?2"}
    first = got["http://h/b?1"]
    assert (first.disasterNumber, first.score, first.lang, first.datetime, first.label) == (1, 2, "Spanish", "s", "L")
    assert (got["http://h/c"].datetime, got["http://h/c"].lang) == ("d", "English")
    assert first.kept_reason == "title_hits>=1"
    strict = articles.select_articles(
        candidates.withColumn("event_pos", F.col("disasterNumber")), ["event_pos", "article_pos"], min_title_hits=2
    )
    assert {r.url for r in strict.collect()} == {"http://h/b?1", "http://h/a?2"}

    paths = [str(tmp_path / n) for n in ("nd", "csv", "csv_keyed", "nd_keyed")]
    writers.write_articles(kept, paths[0], paths[1])
    keys.add_keys(spark, paths[1], paths[0], paths[2], paths[3])
    from_csv = tabular.read_csv(spark, paths[2])
    assert from_csv.columns[0] == "unique_entity_identifier" and "label" not in from_csv.columns
    from_json = spark.read.json(paths[3])
    ids = {r[0] for r in from_csv.select("unique_entity_identifier").collect()}
    assert ids == {r[0] for r in from_json.select("unique_entity_identifier").collect()}
    assert len(ids) == 3
    assert f"2_48453_{hashlib.sha1(b'http://h/a?2').hexdigest()[:10]}" in ids


def test_candidates_carry_what_is_needed_and_give_the_same_articles(spark, tmp_path):
    """Payloads are cut before they meet events, and events described after the dedup."""
    lines = [event(n, "Travis", "flood") for n in (1, 2, 3)] + [event(2, "Travis", "fire")]
    events = articles.ordered_events(spark.createDataFrame(lines, SPINE))
    rng = random.Random(5)
    story = lambda n: [article(rng.choice(["Flood", "Texas fire", "x", None]), f"http://h/{rng.randint(0, 9)}?{n}-{i}") for i in range(9)]
    landed = [(n, "48453", story(n), [] if n == 1 else story(-n)) for n in (1, 2, 2, 3)] + [(3, "48453", None, story(7))]
    payloads = spark.createDataFrame(landed, articles.LANDED_PAYLOAD)
    key = list(articles.EVENT_KEY)
    candidates = articles.attach_payloads(events, payloads, key, "_order", columns=["keywords"], first=6)
    every = articles.attach_payloads(events, payloads, key, "_order").where("article_pos < 6")
    item = [f.name for f in ARTICLE_PAYLOAD["articles"].dataType.elementType]
    assert candidates.columns == ["_order", "keywords", "article_pos", *item]
    assert candidates.count() == every.count() == 6 * 7
    want = articles.select_articles(every, ["_order", "article_pos"]).collect()
    got = articles.first_articles(events, candidates).select(*ARTICLE.names).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(want) > 5


def test_titles_are_scored_once(spark):
    """A filter on the score must not count the hits again."""
    lines = [event(1, "Travis", "flood"), event(2, "Travis", "fire"), event(3, "Bexar", "flood")]
    events = articles.ordered_events(spark.createDataFrame(lines, SPINE))
    story = [article("Flood", "http://h/a?1"), article(None, "http://h/b"), None, article("Texas fire, flood", "http://h/c")]
    landed = [(n, "48453", story, None) for n in (1, 2)] + [(3, "48453", [], story[::-1])]
    payloads = spark.createDataFrame(landed, articles.LANDED_PAYLOAD)
    key = list(articles.EVENT_KEY)
    plain = articles.attach_payloads(events, payloads, key, "_order", columns=["keywords"])
    scored = articles.attach_payloads(events, payloads, key, "_order", columns=[], scored=True)
    assert scored.count() == plain.count() == 12
    want, got = (articles.first_articles(events, c) for c in (plain, scored))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 2
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.upper().count("CONTAINS(") == 1


def test_events_are_sorted_without_what_is_derived(spark, monkeypatch):
    sorted_as = []

    def watched(df):
        sorted_as.append(df.columns)
        return durable(df)

    monkeypatch.setattr("stormledger.operators.numbering.durable", watched)
    made = articles.ordered_events(spark.createDataFrame([event(1, "Travis", "flood")], SPINE))
    assert {"keywords", "startdatetime", "enddatetime", "_order", *articles.EVENT_COLUMNS} <= set(made.columns)
    assert made.first().keywords and not {"keywords", "startdatetime", "_place"} & set(sorted_as[0])


def test_payload_lines_are_the_json_of_their_articles(spark):
    from stormledger.catalog import pipelines

    keys_of = [(2, "00001"), (3, '1"\\é'), (-5, None), (None, "7")]
    lines = pipelines._landed_payloads(spark.createDataFrame(keys_of, "disasterNumber bigint, county_fips string"))

    def story(number, i):
        page = None if number is None else f"http://h/{int(math.fmod(number * 7 + i * 13, 4001))}?{i}"
        return {"title": pipelines.TITLES[i % 3], "url": page, "seendateurl": "", "seendate": f"day {i}", "date": None,
                "sourcecountry": None, "domain": "", "language": ""}

    want = []
    for number, fips in keys_of:
        every = [story(number, i) for i in range(pipelines.PER_PAYLOAD)]
        filled = number is not None and number % 2 == 0
        want.append({"disasterNumber": number, "county_fips": fips, "articles": every if filled else [], "timeline": every})
    assert [json.loads(r.value) for r in lines.collect()] == want
    assert "lambda" not in lines._jdf.queryExecution().optimizedPlan().toString()


def test_an_article_with_both_places_of_an_event_takes_one_rank(spark, monkeypatch):
    """It is ranked and kept once, after one shuffle by event."""
    events = articles.events_from_spine(
        spark.createDataFrame([event(1, "Travis", "flood", designated="Austin")], SPINE)
    )
    titles = ("Flood in Austin", "Flood in Travis County, Texas: Austin")
    seen = [(f"u{i}", titles[i % 2], dt.datetime(2024, 1, 5 + i), "English") for i in range(8)]
    local = spark.createDataFrame(seen, "url string, title string, seen timestamp, language string")
    plans = []

    def watched(df):
        if "article_pos" in df.columns:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return durable(df)

    monkeypatch.setattr(articles, "durable", watched)
    found = articles.match_articles(events, local, per_event=4)
    assert sorted((r.article_pos, r.url) for r in found.collect()) == [(0, "u7"), (1, "u6"), (2, "u5"), (3, "u4")]
    assert [p.count("Exchange hashpartitioning(_event") for p in plans] == [1]


def test_events_are_matched_by_a_number(spark, monkeypatch):
    """Not by a digest of their line; lines that come twice, or without a window, are as before."""
    lines = [event(1, "Travis", "flood")] * 3 + [event(2, "Travis", "flood", "no", "date"), event(3, "Bexar", "flood")]
    events = articles.events_from_spine(spark.createDataFrame(lines, SPINE))
    title = "Flood in Travis County, Texas"
    seen = [(f"u{i}", title, dt.datetime(2024, 1, 5 + i), "English") for i in range(4)] + [("n", None, None, None)]
    local = spark.createDataFrame(seen, "url string, title string, seen timestamp, language string")
    kinds = []
    monkeypatch.setattr(articles, "durable", lambda df: kinds.append(dict(df.dtypes).get("_event")) or durable(df))
    found = articles.match_articles(events, local, per_event=2)
    assert sorted((r.disasterNumber, r.article_pos, r.url) for r in found.collect()) == [(1, 0, "u3")] * 3 + [(1, 1, "u2")] * 3
    assert set(kinds) == {"bigint", None}


def test_keys_of_incomplete_rows_carry_their_line(spark, tmp_path):
    good = '{"disasterNumber": 4332, "county_fips": "48453", "url": " http://a/b "}'
    lacking = '{"disasterNumber": 4332, "county_fips": "48453", "url": ""}'
    (tmp_path / "a.ndjson").write_text("\n".join([good, "", "{bad", good, "  ", lacking]) + "\n")
    rows, bad = keys.keyed_ndjson(spark, str(tmp_path / "a.ndjson"))
    got = sorted(tuple(r) for r in rows.select("unique_entity_identifier", "missing_parts").collect())
    assert got == [("4332_48453_d213c5ed66", None)] * 2 + [("missingpk_ndjson_5", "url")]
    assert [tuple(r) for r in bad.collect()] == [(2, "{bad")]

    with (tmp_path / "a.csv").open("w", newline="") as handle:
        out = csv.writer(handle)
        out.writerow(["disasterNumber", "county_fips", "url", "title"])
        out.writerows([[1, "2", "u", "two\nlines"], [1, "2", "u", ""], [1, "2", "u", "x"], [1, "2", "", "last"]])
    made = keys.keyed_csv(spark, str(tmp_path / "a.csv"))
    assert made.columns == ["unique_entity_identifier", "disasterNumber", "county_fips", "url", "title", "missing_parts", "_row_index"]
    assert {(r.unique_entity_identifier, r.title) for r in made.collect() if r.title == "last"} == {("missingpk_csv_3", "last")}
    assert made.count() == 4


def test_keys_keep_every_field_and_write_what_went_wrong(spark, tmp_path):
    records = [
        {"disasterNumber": "4332", "county_fips": "48453", "url": "http://a/b", "extra": {"x": [1, 2.50]}},
        {"score": 1.5, "disasterNumber": 4332, "county_fips": 48453, "url": "http://a/b"},
        {"unique_entity_identifier": "old $1 \\ x", "disasterNumber": 1, "county_fips": "2", "url": "u"},
        {"disasterNumber": 1, "url": "u"},
        {},
    ]
    lines = [json.dumps(r) for r in records] + ['{"disasterNumber": 1} trailing']
    (tmp_path / "in.ndjson").write_text("\n".join(lines) + "\n")
    with (tmp_path / "in.csv").open("w", newline="") as handle:
        out = csv.writer(handle)
        out.writerows([["disasterNumber", "county_fips", "url", "a.b"], [1, "2", "u", "d"], [1, "2", "", "e"]])
    names = ("in.csv", "in.ndjson", "csv", "ndjson", "audit")
    totals = keys.add_keys(spark, *(str(tmp_path / n) for n in names), run_id="r")
    assert totals == {
        "csv_rows": 2, "csv_fallback": 1, "ndjson_rows": 5, "ndjson_fallback": 2, "malformed": 1,
    }
    key = f"4332_48453_{hashlib.sha1(b'http://a/b').hexdigest()[:10]}"
    other = f"1_2_{hashlib.sha1(b'u').hexdigest()[:10]}"
    found = [key, key, other, "missingpk_ndjson_3", "missingpk_ndjson_4"]
    written = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "ndjson")).collect()]
    want = [r | {"unique_entity_identifier": k} for r, k in zip(records, found)]
    assert sorted(map(str, written)) == sorted(map(str, want))
    assert tabular.read_csv(spark, str(tmp_path / "csv")).columns[-1] == "a.b"
    audit = spark.read.parquet(str(tmp_path / "audit" / "fallback_keys")).collect()
    assert {(r.file_kind, r.place, r.missing_parts) for r in audit} == {
        ("csv", 1, "url"), ("ndjson", 3, "county_fips"), ("ndjson", 4, "disasterNumber,county_fips,url"),
    }
    assert spark.read.parquet(str(tmp_path / "audit" / "malformed")).count() == 1


def test_fallback_keys_are_unique_over_part_files(spark, tmp_path):
    for kind, head in (("csv", "disasterNumber,county_fips,url\n"), ("ndjson", "")):
        (tmp_path / kind).mkdir()
        row = "1,2,\n" if kind == "csv" else '{"disasterNumber": 1, "county_fips": "2"}\n'
        for part, rows in (("part-0", 3), ("part-1", 2), ("part-2", 1)):
            (tmp_path / kind / f"{part}.{kind}").write_text(head + row * rows)
    made = {
        "csv": keys.keyed_csv(spark, str(tmp_path / "csv")),
        "ndjson": keys.keyed_ndjson(spark, str(tmp_path / "ndjson"))[0],
    }
    for kind, rows in made.items():
        got = sorted(r[0] for r in rows.select("unique_entity_identifier").collect())
        assert got == [f"missingpk_{kind}_{i}" for i in range(6)]


def test_empty_county_map_is_an_error(spark, tmp_path):
    (tmp_path / "c.csv").write_text("state_name,county_name_clean,county_geoid\nOhio,Allen,none\n")
    with pytest.raises(ValueError, match="no county"):
        spine.load_county_map(spark, str(tmp_path / "c.csv"))


def test_county_map_takes_the_last_file(spark, tmp_path):
    for name, county, filler in (("a", "Old", 3), ("b", "New", 0)):
        rows = "".join(f"Ohio,F{i},39{i:03d}\n" for i in range(filler))
        (tmp_path / f"{name}.csv").write_text(f"state,county,county_geoid\n{rows}Texas,{county},48453\n")
    known = counties.county_map(tabular.read_counties(spark, str(tmp_path)))
    assert {r.county_name_clean for r in known.collect()} == {"F0", "F1", "F2", "New"}


def match_brute(events, rows, per_event):
    """The matching rule, article by article."""
    def spelled(text):
        return " " + " ".join(re.findall(r"[^\W_]+", text.lower())) + " "

    found = set()
    for number, county, kind, start, end, area in events:
        places = [f"{county} County, Texas"] + ([area] if area else [])
        hits = []
        for url, title, seen, language in rows:
            inside = dt.datetime.fromisoformat(start) <= seen <= dt.datetime.fromisoformat(end)
            placed = any(spelled(p) in spelled(title) for p in places)
            typed = any(spelled(w) in spelled(title) for w in TYPE_SYNONYMS.get(kind, (kind,)))
            if inside and placed and typed and language in ("English", None):
                hits.append((-seen.timestamp(), url))
        found |= {(number, url, pos) for pos, (_, url) in enumerate(sorted(hits)[:per_event])}
    return found


@pytest.mark.parametrize("per_event", [2, 30])
def test_local_match_equals_brute_force(spark, per_event):
    rng = random.Random(per_event)
    titles = ["Travis County, Texas", "TRAVIS COUNTY TEXAS", "Bexar County, Texas", "Greater Austin", "Travis"]
    kinds = ["flash flood", "Flood", "storm", "volcano", "calm"]
    rows = [
        (f"u{i}", f"{rng.choice(titles)}: {rng.choice(kinds)} and {rng.choice(titles)}",
         dt.datetime(2024, 1, 1) + dt.timedelta(hours=12 * rng.randrange(60)), rng.choice(["English", "Spanish", None]))
        for i in range(300)
    ]
    events = [
        (n, rng.choice(["Travis", "Bexar"]), rng.choice(["flood", "storm", "volcano"]),
         f"2024-01-{rng.randrange(1, 20):02d}", f"2024-01-{rng.randrange(10, 31):02d}", rng.choice(["", "Greater Austin"]))
        for n in range(25)
    ]
    made = articles.events_from_spine(
        spark.createDataFrame([event(n, c, k, s, e, a) for n, c, k, s, e, a in events], SPINE)
    )
    table = spark.createDataFrame(rows, "url string, title string, seen timestamp_ntz, language string")
    found = articles.match_articles(made, table, per_event=per_event)
    got = [tuple(r) for r in found.select("disasterNumber", "url", "article_pos").collect()]
    assert len(got) == len(set(got)) and set(got) == match_brute(events, rows, per_event)
    assert got


def test_repeated_event_numbers_keep_their_own_windows(spark):
    """Two lines of one number and county with different windows, one of them twice."""
    title = "Flash flood in Travis County, Texas"
    rows = [(f"u{d}", title, dt.datetime(2024, m, d), "English") for m in (1, 3) for d in range(m * 4, m * 4 + 4)]
    early, late = (event(1, "Travis", "flood", f"2024-{m}-01", f"2024-{m}-28", "") for m in ("01", "03"))
    made = articles.events_from_spine(spark.createDataFrame([early, late, late], SPINE))
    table = spark.createDataFrame(rows, "url string, title string, seen timestamp_ntz, language string")
    found = articles.match_articles(made, table, per_event=3).collect()
    got = sorted((r.window_start, r.article_pos, r.url) for r in found)
    january, march = ["u7", "u6", "u5"], ["u15", "u14", "u13"]
    assert got == sorted(
        [("2024-01-01", i, u) for i, u in enumerate(january)] + [("2024-03-01", i, u) for i, u in enumerate(march)] * 2
    )


@pytest.mark.parametrize("end_of_day", [False, True])
def test_window_ends_at_midnight_or_with_the_day(spark, end_of_day):
    title = "Flash flood in Travis County, Texas"
    hours = [dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 10, 9), dt.datetime(2024, 1, 11)]
    rows = [(f"u{i}", title, at, "English") for i, at in enumerate(hours)]
    made = articles.events_from_spine(
        spark.createDataFrame([event(1, "Travis", "flood", "2024-01-01", "2024-01-10", "")], SPINE)
    )
    table = spark.createDataFrame(rows, "url string, title string, seen timestamp_ntz, language string")
    found = articles.match_articles(made, table, end_of_day=end_of_day)
    assert {r.url for r in found.collect()} == ({"u0", "u1"} if end_of_day else {"u0"})


def test_crawl_manifest_and_ingest(spark, tmp_path):
    places = spark.createDataFrame([("Texas", "Travis"), ("Ohio", "Allen"), ("Utah", "Kane")], "state string, county string")
    work = crawl.work_keys(places)
    assert work.count() == 3 * len(DISASTERS)
    (tmp_path / "log.csv").write_text("state,county,disaster,date_groups,articles\nTexas,Travis,flood,0,0\n")
    pending = crawl.pending_keys(work, tabular.read_done_keys(spark, str(tmp_path / "log.csv")))
    plan = crawl.manifest(pending, seed=3).collect()
    assert len(plan) == 20 and {r.chunk for r in plan} == {0}
    [one] = [r for r in plan if (r.county, r.disaster) == ("Travis", "tornado")]
    assert one.query == '(theme:TORNADO) location:"Travis County, Texas, US"'
    assert one.encoded_query == (
        "%28theme%3ATORNADO%29+location%3A%22Travis+County%2C+Texas%2C+US%22+sourcecountry%3AUS+timespan%3A30d"
    )
    assert crawl.manifest(pending, seed=3, chunk_size=6, max_chunks=2).count() == 12

    text = (
        "DocumentIdentifier,Date,Title,SourceCommonName\n"
        " https://a.b:80/c ,20240110123000,First,\nhttp://late/x,undated,Bad date,S\n"
        "http://late/x,20240110,Good date,S\nhttp://d/1,20240111,Second,Src\n,20240111,No url,\n"
        "https://a.b:80/z,20240110,Third,\n"
    )
    fine, failed = ("Texas", "Travis", "flood"), ("Ohio", "Allen", "flood")
    landed = spark.createDataFrame(
        [(*fine, text, 200), ("Utah", "Kane", "storm", "", 200), (*failed, "", 500)],
        "state string, county string, disaster string, csv_text string, status int",
    )
    assert landed.where(crawl.accepted()).count() == 1
    days = crawl.payload_days(landed)
    by_date = crawl.county_articles(days).collect()
    assert [(r.date, [tuple(a) for a in r.articles]) for r in by_date] == [
        ("2024-01-11", [("Second", "http://d/1", "Src")]),
        ("2024-01-10", [("First", "https://a.b:80/c", "a.b:80"), ("Third", "https://a.b:80/z", "a.b:80")]),
    ]
    log = crawl.progress(days.where("status = 200"))
    assert tuple(log.columns) == PROGRESS_COLUMNS
    assert {tuple(r) for r in log.collect()} == {(*fine, 2, 3), ("Utah", "Kane", "storm", 0, 0)}
    writers.write_csv(log, str(tmp_path / "done"))
    left = crawl.pending_keys(
        spark.createDataFrame([fine, failed], "state string, county string, disaster string"),
        tabular.read_done_keys(spark, str(tmp_path / "done")),
    )
    assert [tuple(r) for r in left.collect()] == [failed]


def test_urls_are_deduped_within_a_payload_only(spark):
    head = "DocumentIdentifier,Date,Title,SourceCommonName\n"
    texts = [head + "http://u,undated,A,s\n", head + "http://u,20240110,B,s\nhttp://u,20240111,C,s\n"]
    landed = spark.createDataFrame(
        [("Texas", "Travis", "flood", t) for t in texts],
        "state string, county string, disaster string, csv_text string",
    )
    days = crawl.payload_days(landed)
    assert "Exchange" not in days._jdf.queryExecution().executedPlan().toString()
    [found] = crawl.county_articles(days).collect()
    assert (found.date, [a.title for a in found.articles]) == ("2024-01-10", ["B"])


def test_index_is_usable_as_event_position(spark):
    df = index_rows(spark.createDataFrame([("b",), ("a",)], "k string"), ["k"])
    assert {tuple(r) for r in df.collect()} == {("a", 0), ("b", 1)}


def test_a_payload_is_parsed_once(spark):
    """No filter ahead of the explosion works the days out again; payloads without days give no row."""
    head = "DocumentIdentifier,Date,Title,SourceCommonName\n"
    text = head + "http://u,20240110,A,s\nhttp://v,20240111,B,\n"
    kinds = {"full": text, "no day": head + "http://u,undated,A,s\n", "head": head, "empty": "", "null": None}
    schema = "state string, county string, disaster string, csv_text string"
    landed = spark.createDataFrame([(k, None, "flood", t) for k, t in kinds.items()] * 2, schema)
    made = crawl.county_articles(crawl.payload_days(landed))
    assert made._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(csv_text") == 1
    assert sorted((r.state, r.county, r.date, r.articles[0].title) for r in made.collect()) == sorted(
        [("full", None, "2024-01-10", "A"), ("full", None, "2024-01-11", "B")] * 2
    )
    rows = payloads.csv_payload_rows(landed, "csv_text", ["Title"], "state")
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(csv_text") == 1
    assert sorted(tuple(r) for r in rows.collect()) == sorted([("full", 0, "A"), ("full", 1, "B"), ("no day", 0, "A")] * 2)
