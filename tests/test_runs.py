"""Jobs started on paths, as a user starts them."""

from __future__ import annotations

import json

from stormledger.plans import articles, counties, crawl
from stormledger.schemas import SPINE
from stormledger.sources import tabular
from stormledger.storage import durable


def records(folder):
    lines = [x for p in sorted(folder.glob("part-*")) for x in p.read_text().splitlines()]
    return [json.loads(x) for x in lines]


def test_run_counties(spark, tmp_path):
    (tmp_path / "states.json").write_text('[["NAME", "state"],\n ["Texas", "48"], ["California", "06"]]')
    for code, row in (("48", ["Travis County, Texas", "48", "453"]), ("06", ["Kern County, California", "06", "29"])):
        folder = tmp_path / "counties" / f"state_fips={code}"
        folder.mkdir(parents=True)
        (folder / "payload.json").write_text(json.dumps([["NAME", "state", "county"], row], indent=1))
    counties.run_counties(
        spark, *(str(tmp_path / n) for n in ("states.json", "counties", "csv", "json"))
    )
    rows = tabular.read_counties(spark, str(tmp_path / "csv")).collect()
    assert {(r.state_name, r.county_name_clean, r.county_geoid) for r in rows} == {
        ("Texas", "Travis", "48453"), ("California", "Kern", "06029"),
    }
    parts = sorted((tmp_path / "json").glob("part-*"))
    array = json.loads("".join(p.read_text() for p in parts))
    assert [r["county_geoid"] for r in array] == ["06029", "48453"]


def test_run_articles_has_one_order(spark, tmp_path):
    """Later declarations first, then the number: not the order of files or appends."""

    def event(number, date, kind="flood"):
        row = dict.fromkeys(SPINE.names, "x") | {
            "state": "Texas", "county": "Travis", "county_fips": "48453", "disaster": kind, "date": date,
            "fema_disaster_number": number, "window_start": "2024-01-03", "window_end": "2024-01-26",
        }
        return json.dumps(row)

    lines = [event(2, "2024-01-01"), "", "{cut", event(1, "2024-01-01"), event(3, "2024-01-02")]
    lines.append(event("4", "2023-01-01"))
    story = {"title": "Flood", "url": "http://h/shared?a", "language": "English"}
    payload = [
        {"disasterNumber": n, "county_fips": "48453",
         "articles": [story | {"url": f"http://h/shared?{n}"}, story | {"url": f"http://h/{n}"}, story]}
        for n in (1, 2, 3, "4")
    ]
    (tmp_path / "payload.ndjson").write_text("\n".join([*map(json.dumps, payload), "{broken"]))
    for run, order in enumerate((lines, lines[::-1])):
        folder = tmp_path / f"run{run}"
        folder.mkdir()
        for i, line in enumerate(order):  # as several appends leave it
            (folder / f"part-{i}.ndjson").write_text(line + "\n")
        totals = articles.run_articles(
            spark, str(folder), str(tmp_path / "payload.ndjson"), str(tmp_path / f"nd{run}"),
            str(tmp_path / f"csv{run}"), per_event=2,
        )
        assert totals == {"candidates": 8, "kept": 5, "malformed_events": 1, "malformed_payloads": 1}
        kept = {r["url"]: r["disasterNumber"] for r in records(tmp_path / f"nd{run}")}
        assert kept == {"http://h/shared?3": 3, "http://h/3": 3, "http://h/2": 2, "http://h/1": 1, "http://h/4": 4}
        assert tabular.read_csv(spark, str(tmp_path / f"csv{run}")).count() == 5


def test_crawl_goes_on_where_it_stopped(spark, tmp_path):
    (tmp_path / "counties.csv").write_text("state_name,county_name_clean\nTexas,Travis\n")
    paths = {n: str(tmp_path / n) for n in ("counties.csv", "log", "work", "work2", "payload", "out")}
    crawl.run_manifest(spark, paths["counties.csv"], paths["log"], paths["work"], seed=1)
    assert len(records(tmp_path / "work")) == 7
    text = "DocumentIdentifier,Date,Title,SourceCommonName\nhttp://a/1,20240110,T," + "s" * 100 + "\n"
    answers = [("flood", 200, text), ("storm", 200, ""), ("drought", 429, "")]
    (tmp_path / "payload").write_text(
        "\n".join(
            json.dumps({"state": "Texas", "county": "Travis", "disaster": d, "status": s, "csv_text": t})
            for d, s, t in answers
        )
    )
    crawl.run_ingest(spark, paths["payload"], paths["out"], paths["log"])
    [found] = records(tmp_path / "out")
    assert (found["date"], found["disaster"], found["articles"][0]["url"]) == ("2024-01-10", "flood", "http://a/1")
    crawl.run_manifest(spark, paths["counties.csv"], paths["log"], paths["work2"], seed=1)
    assert {r["disaster"] for r in records(tmp_path / "work2")} == {
        "hurricane", "tornado", "wildfire", "earthquake", "drought",
    }


def test_payloads_are_landed_as_the_articles_to_take(spark, tmp_path, monkeypatch):
    """Neither the list that is not used nor articles beyond the first are written again."""
    landed = []

    def watched(df):
        landed.append(df.schema)
        return durable(df)

    monkeypatch.setattr("stormledger.sources.ndjson.durable", watched)
    row = dict.fromkeys(SPINE.names, "x") | {
        "state": "Texas", "county": "Travis", "county_fips": "48453", "disaster": "flood",
        "fema_disaster_number": 1, "window_start": "2024-01-03", "window_end": "2024-01-26",
    }
    story = [{"title": "Flood", "url": f"http://h/{i}"} for i in range(5)]
    payloads = [
        {"disasterNumber": 1, "county_fips": "48453", "articles": [], "timeline": story},
        {"disasterNumber": 1, "county_fips": "48453", "articles": story[::-1], "timeline": story[:1]},
    ]
    (tmp_path / "spine.ndjson").write_text(json.dumps(row))
    (tmp_path / "payload.ndjson").write_text("\n".join([*map(json.dumps, payloads), "{broken"]))
    paths = [str(tmp_path / n) for n in ("spine.ndjson", "payload.ndjson", "nd", "csv")]
    totals = articles.run_articles(spark, *paths, per_event=2, bad_root=str(tmp_path / "bad"), run_id="r")
    assert totals == {"candidates": 4, "kept": 4, "malformed_events": 0, "malformed_payloads": 1}
    assert {r["url"] for r in records(tmp_path / "nd")} == {f"http://h/{i}" for i in (0, 1, 3, 4)}
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "bad" / "payloads" / "run_id=r")).collect()] == ["{broken"]
    assert landed[1].names == ["disasterNumber", "county_fips", "_offered", "_corrupt_record"]
