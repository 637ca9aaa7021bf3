"""Joins, numbering, dedup and grouping, checked against plain Python."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from stormledger.operators import dedup, filters, joins, numbering, phrases, ranking, rollups
from stormledger.storage import durable

DAY = dt.datetime(2024, 1, 1)
EVENT = "e int, place string, w0 date, w1 date"
POINT = "place string, at timestamp_ntz, p int"


def random_case(seed, events=60, points=600, days=90, longest=40):
    rng = random.Random(seed)
    # Half of all rows sit at one place.
    place = lambda: "hot" if rng.random() < 0.5 else rng.choice("abc")
    made = []
    for e in range(events):
        first = DAY.date() + dt.timedelta(days=rng.randrange(days))
        made.append((e, place(), first, first + dt.timedelta(days=rng.randrange(-3, longest))))
    seen = []
    for p in range(points):
        at = DAY + dt.timedelta(days=rng.randrange(days), hours=rng.choice([0, 0, 7, 23]))
        seen.append((place(), at, p))
    return made, seen


def brute_pairs(events, points):
    return {
        (e, p): at
        for e, place, w0, w1 in events
        for where, at, p in points
        if where == place
        and dt.datetime.combine(w0, dt.time()) <= at <= dt.datetime.combine(w1, dt.time())
    }


@pytest.fixture(params=["10m", "-1"])
def broadcast_below(spark, request):
    """With and without broadcast joins."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("bucket_days", [1, 8, 400])
def test_interval_join_equals_all_pairs(spark, broadcast_below, bucket_days):
    events, points = random_case(bucket_days)
    joined = joins.interval_join(
        spark.createDataFrame(events, EVENT),
        spark.createDataFrame(points, POINT),
        ["place"], "w0", "w1", "at",
        bucket_days=bucket_days,
    ).select("e", "p")
    got = [tuple(r) for r in joined.collect()]
    assert len(got) == len(set(got))
    assert set(got) == set(brute_pairs(events, points))


@pytest.mark.parametrize("days", [0, 21, 365])
def test_interval_join_copies_an_event_twice_or_so(spark, broadcast_below, days):
    first = dt.date(2024, 1, 1)
    events = [(e, e % 5, first + dt.timedelta(e), first + dt.timedelta(e + days)) for e in range(100)]
    points = [(p, p % 5, dt.datetime(2024, 1, 1) + dt.timedelta(p * 3)) for p in range(200)]
    frame = spark.createDataFrame(events, "e int, place int, w0 date, w1 date")
    width = joins._mean_days(frame, "w0", "w1")
    assert width == days + 1 and joins._spread(frame, "w0", "w1", width).count() <= 2 * len(events)
    assert joins._mean_days(frame.where("e < 0"), "w0", "w1") == 1
    joined = joins.interval_join(
        frame,
        spark.createDataFrame(points, "p int, place int, at timestamp"),
        ["place"], "w0", "w1", "at",
    )
    want = {(e, p) for e, k, w0, w1 in events for p, of, at in points if k == of and w0 <= at.date() <= w1}
    assert {(r.e, r.p) for r in joined.collect()} == want and want


def test_interval_join_of_odd_rows(spark, broadcast_below):
    """No place, no instant, no or an inverted window, rows that come twice, no rows. Points do
    not carry their bucket."""
    first, day = DAY.date(), dt.timedelta(days=1)
    events = [(1, "a", first, first + 3 * day), (2, None, first, first), (3, "a", None, first), (4, "a", first, None),
              (5, "a", first + day, first), (1, "a", first, first + 3 * day)]
    points = [("a", DAY + 3 * day, 1), ("a", DAY + 3 * day, 1), ("a", DAY + 4 * day, 2), (None, DAY, 3), ("a", None, 4), ("b", DAY, 5)]

    def joined(events, points):
        return joins.interval_join(
            spark.createDataFrame(events, EVENT), spark.createDataFrame(points, POINT), ["place"], "w0", "w1", "at"
        )

    found = joined(events, points)
    assert found.columns == ["place", "e", "w0", "w1", "at", "p"]
    assert [tuple(r) for r in found.collect()] == [("a", 1, first, first + 3 * day, DAY + 3 * day, 1)] * 4
    assert joined([], points).count() == joined(events, []).count() == 0
    assert "AS _bucket" not in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(("seed", "n"), [(1, 1), (2, 3), (3, 30), (4, 1000)])
def test_newest_in_window_equals_ranked_pairs(spark, seed, n):
    events, points = random_case(seed)
    found = joins.newest_in_window(
        spark.createDataFrame(events, EVENT),
        spark.createDataFrame(points, POINT),
        ["place"], "w0", "w1", "at", ["p"], n,
    )
    assert set(found.columns) == {"e", "place", "w0", "w1", "at", "p", "rank"}
    want = {}
    for (e, p), at in brute_pairs(events, points).items():
        want.setdefault(e, []).append((-at.timestamp(), p))
    ranked = {
        (e, p, rank)
        for e, seen in want.items()
        for rank, (_, p) in enumerate(sorted(seen)[:n], start=1)
    }
    got = [tuple(r) for r in found.select("e", "p", "rank").collect()]
    assert len(got) == len(set(got)) and set(got) == ranked


@pytest.mark.parametrize("end_of_day", [False, True])
def test_newest_in_window_of_odd_rows(spark, end_of_day):
    """No place, no instant, no or an inverted window, events that come twice, a hot place; no rows."""
    first, day = DAY.date(), dt.timedelta(days=1)
    events = [(1, "a", first, first + 3 * day), (2, None, first, first + day), (3, "a", None, first), (4, "a", first, None),
              (5, "a", first + day, first), (6, "b", first, first), (7, "none", first, first)] + [(1, "a", first, first + 3 * day)]
    points = [("a", DAY + dt.timedelta(hours=6 * h), h) for h in range(20)] + [("a", DAY + day, p) for p in range(100, 130)]
    points += [(None, DAY, 1), ("a", None, 2), ("b", DAY, 3), ("b", DAY + dt.timedelta(hours=1), 4), ("c", DAY, 5)]

    def newest(events, points, n):
        found = joins.newest_in_window(
            spark.createDataFrame(events, EVENT), spark.createDataFrame(points, POINT),
            ["place"], "w0", "w1", "at", ["p"], n, end_of_day,
        )
        return sorted(tuple(r) for r in found.select("e", "p", "rank").collect())

    for n in (1, 7, 50):
        want = []
        for e, place, w0, w1 in events:
            if place is None or w0 is None or w1 is None or w0 > w1:
                continue
            until = dt.datetime.combine(w1 + day * end_of_day, dt.time()) - dt.timedelta(microseconds=int(end_of_day))
            inside = [(at, p) for k, at, p in points if k == place and at and DAY <= at <= until]
            ranked = sorted(inside, key=lambda x: (-x[0].timestamp(), x[1]))[:n]
            want += [(e, p, rank) for rank, (_, p) in enumerate(ranked, start=1)]
        assert newest(events, points, n) == sorted(want) and want
    assert newest([], points, 3) == newest(events, [], 3) == []


def test_newest_in_window_shuffles_its_counts_once(spark, monkeypatch):
    """The three joins with the counts share a shuffle; points and edges are counted by one."""
    events, points = random_case(5)
    plans, before = [], {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    shown = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(joins, "durable", lambda df: plans.append(shown(df)) or durable(df))
    for k, v in zip(before, ("-1", "false"), strict=True):
        spark.conf.set(k, v)
    try:
        found = joins.newest_in_window(
            spark.createDataFrame(events, EVENT), spark.createDataFrame(points, POINT),
            ["place"], "w0", "w1", "at", ["p"], 3,
        )
        plans.append(shown(found))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    counted, joined = plans
    assert counted.count("Exchange hashpartitioning") == 2 and joined.count("ReusedExchange") == 2


def test_find_phrases_in_texts_of_one_id(spark, broadcast_below, monkeypatch):
    """Ids that come twice or are missing, also with other texts; a phrase is sent as it is, once."""
    kept = []
    monkeypatch.setattr(phrases, "durable", lambda df: kept.append(df.columns) or durable(df))
    texts = [(1, "Flash flood"), (1, "Flash flood"), (1, "a storm"), (2, "flood, flash"), (None, "flash flood, storm"), (3, None)]
    found = phrases.find_phrases(
        spark.createDataFrame(texts, "id int, t string"), ["id"], "t",
        spark.createDataFrame([("flash FLOOD",), ("Flash-Flood",), ("storm",), ("storm",), (None,)], "phrase string"),
    )
    got = [tuple(r) for r in found.select("id", "phrase").collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(1, "flash FLOOD"), (1, "Flash-Flood"), (1, "storm"), (None, "storm")}
    assert kept[-1] == ["id", "_phrase", "_single"]


def test_lookup_keeps_or_drops(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b")], "n int, k string")
    dim = spark.createDataFrame([("a", "A")], "k string, v string")
    assert [r.n for r in joins.lookup(facts, dim, ["k"]).collect()] == [1]
    kept = joins.lookup(facts, dim, ["k"], keep_unmatched=True).orderBy("n").collect()
    assert [r.v for r in kept] == ["A", None]


WORDS = ["storm", "flash", "flood", "travis", "county", "texas", "é", "a", "1"]


@pytest.mark.parametrize("seed", [1, 2])
def test_find_phrases_equals_search(spark, broadcast_below, seed):
    rng = random.Random(seed)
    join = lambda n: "".join(rng.choice(WORDS) + rng.choice([" ", ", ", "-", "\n"]) for _ in range(n))
    texts = [(i, join(rng.randrange(0, 60))) for i in range(40)] + [(99, None), (98, "")]
    wanted = {join(rng.randrange(0, 8)).upper() for _ in range(60)} | {"Flash Flood", "storm"}
    found = phrases.find_phrases(
        spark.createDataFrame(texts, "id int, t string"),
        ["id"], "t",
        spark.createDataFrame([(w,) for w in wanted], "phrase string"),
    )

    def spelled(text):
        return " " + " ".join(re.findall(r"[^\W_]+", (text or "").lower())) + " "

    want = {
        (i, w) for i, t in texts for w in wanted if spelled(w).strip() and spelled(w) in spelled(t)
    }
    got = [tuple(r) for r in found.select("id", "phrase").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_find_no_phrases(spark):
    none = spark.createDataFrame([("...",)], "phrase string")
    texts = spark.createDataFrame([(1, "storm")], "id int, t string")
    assert phrases.find_phrases(texts, ["id"], "t", none).collect() == []


@pytest.mark.parametrize("rows", [0, 1, 39, 40, 1000])
def test_index_and_chunks(spark, rows):
    df = spark.range(rows).select((F.col("id") * 7919 % 10007).alias("v")).repartition(5)
    got = [(r.v, r.row_index) for r in numbering.index_rows(df, ["v"]).collect()]
    assert sorted(got) == [(v, i) for i, v in enumerate(sorted(v for v, _ in got))]
    chunks = numbering.assign_chunks(df, ["v"]).groupBy("chunk").count().collect()
    assert sorted(r["count"] for r in chunks) == sorted(
        [20] * (rows // 20) + ([rows % 20] if rows % 20 else [])
    )
    limited = numbering.assign_chunks(df, ["v"], max_chunks=1)
    assert limited.count() == min(rows, 20)


def test_keep_first_and_last(spark):
    rows = [("a", 2, None), ("a", 1, "x"), ("a", 3, "y"), ("b", None, "z"), (None, 5, "n")]
    df = spark.createDataFrame(rows, "k string, pos int, v string").repartition(3)
    first = dedup.keep_first(df, ["k"], "pos")
    assert {tuple(r) for r in first.collect()} == {("a", 1, "x"), ("b", None, "z"), (None, 5, "n")}
    last = dedup.keep_last(df, ["k"], "pos")
    assert {tuple(r) for r in last.collect()} == {("a", 3, "y"), ("b", None, "z"), (None, 5, "n")}
    downwards = dedup.keep_first(df.where("k = 'a'"), ["k"], -F.col("pos"))
    assert [tuple(r) for r in downwards.collect()] == [("a", 3, "y")]
    assert {tuple(r) for r in dedup.keep_first(first, ["k"], "pos").collect()} == {
        tuple(r) for r in first.collect()
    }


def test_dedup_and_filter_do_not_commute(spark):
    df = spark.createDataFrame([("u", 0, ""), ("u", 1, "2024-01-10")], "url string, pos int, d string")
    dated = F.col("d") != ""
    assert dedup.dedup_then_filter(df, ["url"], ["pos"], dated).count() == 0
    assert dedup.filter_then_dedup(df, ["url"], ["pos"], dated).count() == 1


def test_keep_first_url_over_events(spark):
    df = spark.createDataFrame(
        [(2, "http://h/a?x=1"), (1, "http://h/a?x=2"), (3, "http://h/b")], "pos int, url string"
    )
    assert {r.url for r in dedup.keep_first_url(df, "url", "pos").collect()} == {
        "http://h/a?x=2", "http://h/b",
    }


def test_top_n_and_pages(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    top = ranking.top_n_per_group(df, ["g"], [F.col("id").desc()], 2)
    assert {(r.g, r.id, r["rank"]) for r in top.collect()} == {
        (0, 99, 1), (0, 96, 2), (1, 97, 1), (1, 94, 2), (2, 98, 1), (2, 95, 2),
    }
    page = ranking.page_slice(df, [F.col("id").desc()], skip=10, pages=2, size=5)
    assert [r.id for r in page.orderBy(F.col("id").desc()).collect()] == list(range(89, 79, -1))
    shuffled = [r.id for r in ranking.seeded_order(df, ["id"], seed=1).orderBy("place").collect()]
    assert sorted(shuffled) == list(range(100)) and shuffled != sorted(shuffled)
    assert shuffled == [r.id for r in ranking.seeded_order(df, ["id"], seed=1).orderBy("place").collect()]
    assert shuffled != [r.id for r in ranking.seeded_order(df, ["id"], seed=2).orderBy("place").collect()]


def test_hot_group_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    plan = ranking.top_n_per_group(df, ["g"], [F.col("id")], 2)._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2
    plan = dedup.keep_first(df, ["g"], "id")._jdf.queryExecution().toString()
    assert "partial_min(struct" in plan


@pytest.mark.parametrize("seed", range(3))
def test_payload_rows_by_date(spark, seed):
    rng = random.Random(seed)
    size = rng.choice([0, 1, 40, 12_000])
    rows = [(i, f"u{rng.randrange(1 + size // 2)}", f"2024-01-{rng.randint(1, 28):02}") for i in range(size)]
    shuffled = rng.sample(rows, len(rows))
    df = spark.createDataFrame(
        [(shuffled,)], "rows array<struct<article_pos: int, url: string, date: string>>"
    )
    first = rollups.first_by(F.col("rows"), "url")
    [made] = df.select(rollups.articles_by_date(first, "date", ["url"]).alias("days")).collect()
    seen, want = set(), {}
    for _, url, date in rows:
        if url not in seen:
            seen.add(url)
            want.setdefault(date, []).append(url)
    got = [(d.date, [a.url for a in d.articles]) for d in made.days]
    assert got == sorted(want.items(), reverse=True)


def test_progress_keeps_zero_rows(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    articles = spark.createDataFrame([("a", "d1"), ("a", "d1"), ("a", "d2")], "k string, date string")
    rows = rollups.progress_rollup(keys, articles, ["k"], "date").collect()
    assert sorted(tuple(r) for r in rows) == [("a", 2, 3), ("b", 0, 0)]


def test_declaration_filter_bounds(spark):
    stamps = ["2014-12-31T23:59:59.000Z", "2015-01-01T00:00:00.000Z", "2015-06-30T23:59:59.000Z",
              "2015-07-01T00:00:00.000Z"]
    df = spark.createDataFrame([(s, "TX", "Flood") for s in stamps] + [(stamps[1], "TX", "flood"), (stamps[1], "AZ", "Fire")],
                               "d string, s string, t string")
    columns = F.col("d"), F.col("s"), F.col("t")
    assert df.where(filters.declaration_filter(*columns)).count() == 5
    bounded = filters.declaration_filter(*columns, end="2015-06-30", state_code="tx", types=" Flood ,Fire")
    assert [r.d for r in df.where(bounded).collect()] == stamps[1:3]


def test_required_and_not_empty(spark):
    df = spark.createDataFrame([("a", "b"), ("a", " "), ("", "b"), (None, "b")], "x string, y string")
    assert df.where(filters.required_fields(F.col("x"), F.col("y"))).count() == 1
    assert df.where(filters.not_empty(F.col("x"), F.col("y"))).count() == 2
