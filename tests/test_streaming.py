"""Streams give the batch result, take each file once, and go on after a restart."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from stormledger.operators.seen import SeenUrls
from stormledger.plans import spine
from stormledger.schemas import SPINE
from stormledger.sources.payloads import read_declaration_pages
from stormledger.streaming import articles as stream_articles
from stormledger.streaming.spine import start_classified_stream, stream_declaration_pages
from stormledger.streaming.urls import first_urls, kept_urls, start_first_urls


def page(numbers):
    rows = [
        {"disasterNumber": n, "declarationDate": "2024-02-01T00:00:00.000Z", "incidentType": "Fire",
         "fipsStateCode": "48", "fipsCountyCode": "453" if n % 2 else "000"}
        for n in numbers
    ]
    return json.dumps({"DisasterDeclarationsSummaries": rows}, indent=1)


def test_spine_stream_restarts_where_it_stopped(spark, tmp_path):
    known = spark.createDataFrame(
        [("48453", "Texas", "Travis")], "county_fips string, state_name string, county_name_clean string"
    )
    pages, out, checkpoint = (str(tmp_path / n) for n in ("pages", "out", "checkpoint"))
    (tmp_path / "pages").mkdir()
    for name, numbers in (("1", range(10)), ("2", range(10, 13)), (None, ())):
        if name:
            (tmp_path / "pages" / f"{name}.json").write_text(page(numbers))
        start_classified_stream(
            stream_declaration_pages(spark, pages), known, out, checkpoint
        ).awaitTermination()
    landed = spark.read.parquet(out)
    batch = spine.classify(read_declaration_pages(spark, pages), known)
    assert landed.count() == 13
    for part in (spine.spine, spine.spine_log):
        assert sorted(map(str, part(landed).collect())) == sorted(map(str, part(batch).collect()))


def test_late_rows_of_new_urls_are_kept(spark, tmp_path):
    """Each run a year earlier than the last: without a watermark no row is too late."""
    for run in range(3):
        rows = spark.createDataFrame(
            [(f"http://h/{run}?a", f"{2024 - run}-01-01 00:00:00"), ("http://h/0?b", f"{2024 - run}-06-01 00:00:00")],
            "url string, seen string",
        )
        rows.write.mode("append").json(str(tmp_path / "in"))
        stream = spark.readStream.schema("url string, seen timestamp").json(str(tmp_path / "in"))
        (
            first_urls(stream, "url", "seen")
            .writeStream.format("json")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    kept = [r.url_base for r in spark.read.json(str(tmp_path / "out")).collect()]
    assert sorted(kept) == ["http://h/0", "http://h/1", "http://h/2"]


def test_url_stream_keeps_one_row_per_url_across_runs(spark, tmp_path):
    schema = "url string, seen timestamp, n int"
    for run in range(3):
        rows = spark.range(200).select(
            F.concat(F.lit("http://h/"), (F.col("id") % 5 + run).cast("string"), F.lit("?"), F.col("id").cast("string")).alias("url"),
            F.expr("timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id)").alias("seen"),
            F.lit(run).alias("n"),
        )
        rows.write.mode("append").json(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        (
            first_urls(stream, "url", "seen", "30 days")
            .writeStream.format("json")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    kept = spark.read.json(str(tmp_path / "out"))
    assert kept.count() == 7
    assert {r.url_base: r.n for r in kept.collect()} == {
        **{f"http://h/{i}": 0 for i in range(5)}, "http://h/5": 1, "http://h/6": 2,
    }


def _payload(number, *urls):
    story = {"title": "Flood in Travis", "seendate": "x", "language": "English"}
    return json.dumps(
        {"disasterNumber": number, "county_fips": "48453", "articles": [story | {"url": u} for u in urls]}
    )


def _event(number, date):
    return dict.fromkeys(SPINE.names, "x") | {
        "state": "Texas", "county": "Travis", "county_fips": "48453", "disaster": "flood",
        "fema_disaster_number": number, "date": date,
        "window_start": "2024-01-03", "window_end": "2024-01-26",
    }


def _article_stream(spark, tmp_path):
    spine = spark.createDataFrame([tuple(_event(n, f"2024-01-0{n}").values()) for n in (1, 2, 3)], SPINE)
    events = stream_articles.fix_events(spark, spine, str(tmp_path / "store"), "v1")
    paths = [str(tmp_path / n) for n in ("payloads", "store", "checkpoint")]
    query = stream_articles.start_article_stream(spark, events, *paths, slots=2)
    query.awaitTermination()


def test_two_triggers_equal_one_batch(spark, tmp_path):
    (tmp_path / "payloads").mkdir()
    first = [_payload(3, "http://h/a?1", "http://h/b"), "{broken", _payload(3, "http://h/c")]
    second = [_payload(2, "http://h/a?2", "http://h/d"), _payload(1, "http://h/d?x", "http://h/e")]
    for name, lines in (("1", first), ("2", second), ("3", None)):
        if lines:
            (tmp_path / "payloads" / name).write_text("\n".join(lines))
        _article_stream(spark, tmp_path)
    got = {(r.disasterNumber, r.url) for r in stream_articles.articles_so_far(spark, str(tmp_path / "store")).collect()}
    assert got == {(3, "http://h/a?1"), (3, "http://h/b"), (3, "http://h/c"), (2, "http://h/d"), (1, "http://h/e")}


@pytest.mark.parametrize("cut_in", ["before", "after"])
def test_a_trigger_cut_short_is_repeated_once(spark, tmp_path, monkeypatch, cut_in):
    (tmp_path / "payloads").mkdir()
    (tmp_path / "payloads" / "1").write_text(_payload(3, "http://h/a", "http://h/b"))
    add, calls = SeenUrls.add, []

    def cut(self, *args):
        calls.append(cut_in)
        if len(calls) == 1 and cut_in == "before":
            raise RuntimeError("cut")
        made = add(self, *args)
        if len(calls) == 1:
            raise RuntimeError("cut")
        return made

    monkeypatch.setattr(SeenUrls, "add", cut)
    with pytest.raises(Exception, match="cut"):
        _article_stream(spark, tmp_path)
    _article_stream(spark, tmp_path)
    found = stream_articles.articles_so_far(spark, str(tmp_path / "store"))
    assert sorted(r.url for r in found.collect()) == ["http://h/a", "http://h/b"]
    assert len(calls) == 2


def test_no_articles_yet(spark, tmp_path):
    assert stream_articles.articles_so_far(spark, str(tmp_path)).count() == 0


def test_late_new_urls_are_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    batches = (
        [("http://h/a?1", "2024-01-10"), ("http://h/a?2", "2024-01-09"), ("http://h/b", "2024-01-10")],
        [("http://h/old", "1999-01-01"), ("http://h/b?x", "1999-01-01"), ("http://h/c", "2024-02-01")],
    )
    for n, rows in enumerate(batches):
        lines = [json.dumps({"url": u, "seen": s}) for u, s in rows]
        (tmp_path / "in" / f"{n}.json").write_text("\n".join(lines))
        stream = spark.readStream.schema("url string, seen date").json(str(tmp_path / "in"))
        start_first_urls(
            stream, "url", str(tmp_path / "seen"), str(tmp_path / "checkpoint"), "seen", slots=2
        ).awaitTermination()
    kept = kept_urls(SeenUrls(spark, str(tmp_path / "seen"))).collect()
    assert sorted(r.url for r in kept) == ["http://h/a?2", "http://h/b", "http://h/c", "http://h/old"]


def test_the_index_is_asked_for_one_row_per_url(spark, tmp_path, monkeypatch):
    (tmp_path / "payloads").mkdir()
    urls = [[f"http://h/{i % 4}?{n}-{i}" for i in range(40)] for n in (1, 2, 3)]
    lines = [_payload(n, *of) for n, of in zip((1, 2, 3), urls)]
    (tmp_path / "payloads" / "1").write_text("\n".join(lines))
    add, asked = SeenUrls.add, []

    def counted(self, run_id, batch, *args):
        asked.append(batch.count())
        return add(self, run_id, batch, *args)

    monkeypatch.setattr(SeenUrls, "add", counted)
    _article_stream(spark, tmp_path)
    found = stream_articles.articles_so_far(spark, str(tmp_path / "store")).collect()
    assert sorted(r.url for r in found) == sorted(urls[2][:4]) and {r.county for r in found} == {"Travis"}
    assert asked == [4]
