"""Buckets that meet where they lie."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stormledger.plans.articles import attach_payloads, events_from_spine
from stormledger.plans.colocated import attach_saved, buckets_for, register, save_bucketed
from stormledger.schemas import ARTICLE_PAYLOAD, SPINE

_FIELDS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ARTICLE_PAYLOAD)
PAYLOAD = f"disasterNumber bigint, county_fips string, {_FIELDS}"


def tables(spark):
    event = dict.fromkeys(SPINE.names, "x") | {"county": "Travis", "state": "Texas", "disaster": "flood"}
    spine = spark.createDataFrame(
        [tuple((event | {"fema_disaster_number": n, "county_fips": f"{n % 7:05d}"}).values()) for n in range(40)], SPINE
    )
    events = events_from_spine(spine)
    story = {f.name: "s" for f in ARTICLE_PAYLOAD["articles"].dataType.elementType}
    rows = [
        (n, f"{n % 7:05d}", [story | {"url": f"u{n}-{i}"} for i in range(n % 3)], None) for n in range(5, 60)
    ]
    return events, spark.createDataFrame(rows, PAYLOAD)


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("BroadcastExchange")


def test_saved_tables_meet_without_a_shuffle(spark, tmp_path):
    events, payloads = tables(spark)
    names = [f"t{uuid.uuid4().hex}" for _ in range(3)]
    paths = [str(tmp_path / n) for n in names]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        save_bucketed(events, names[0], paths[0], buckets=8)
        for part in (F.col("disasterNumber") < 30, F.col("disasterNumber") >= 30):  # two runs
            save_bucketed(payloads.where(part), names[1], paths[1], buckets=8)
        saved = attach_saved(spark, names[0], names[1], "disasterNumber")
        plain = attach_payloads(events, payloads, ("disasterNumber", "county_fips"), "disasterNumber")
        assert exchanges(saved) == (0, 0) and exchanges(plain)[0] > 0
        key = lambda r: (r.disasterNumber, r.article_pos, r.url)
        assert sorted(map(key, saved.collect())) == sorted(map(key, plain.collect()))
        register(spark, names[2], paths[1], PAYLOAD, buckets=8)
        again = attach_saved(spark, names[0], names[2], "disasterNumber")
        assert again.count() == saved.count() and exchanges(again) == (0, 0)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_buckets_become_more_not_longer(spark, tmp_path):
    small, large = spark.range(50).toDF("k"), spark.range(4000).toDF("k")
    assert [buckets_for(small, large, rows=n) for n in (10_000, 500, 400, 100)] == [8, 8, 16, 64]
    assert buckets_for(small.where("k < 0"), least=1) == 1
    name = f"t{uuid.uuid4().hex}"
    try:
        save_bucketed(large, name, str(tmp_path / name), ["k"], buckets_for(large, rows=100))
        read = spark.table(name).groupBy(F.input_file_name()).count().collect()
        assert len(read) == 64 and max(r["count"] for r in read) < 200
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
