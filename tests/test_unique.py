"""Short keys that different URLs share."""

from __future__ import annotations

import hashlib
import itertools
import json

import pytest
from pyspark.sql import functions as F

from stormledger.operators.unique import conflicts, told_apart
from stormledger.plans import keys
from stormledger.schemas import ROW_KEY_COLUMN


@pytest.fixture(scope="module")
def two_urls():
    """URLs whose hashes begin with the same ten digits."""
    seen: dict = {}
    for i in itertools.count():
        url = f"http://h/{i}"
        short = hashlib.sha1(url.encode()).digest()[:5]
        if short in seen:
            return seen[short], url
        seen[short] = url


def test_a_real_conflict_in_both_files(spark, tmp_path, two_urls):
    one, two = sorted(two_urls, key=lambda u: hashlib.sha1(u.encode()).hexdigest())
    rows = [("1", "48453", one), ("1", "48453", two), ("1", "48453", f" {two} "), ("2", "48453", two), ("1", "1", "x")]
    (tmp_path / "csv").mkdir()
    (tmp_path / "nd").mkdir()
    lines = ["disasterNumber,county_fips,url", *(",".join(r) for r in rows)]
    (tmp_path / "csv" / "a.csv").write_text("\n".join(lines) + "\n")
    names = ("disasterNumber", "county_fips", "url")
    (tmp_path / "nd" / "a.ndjson").write_text("\n".join(json.dumps(dict(zip(names, r))) for r in rows))
    paths = [str(tmp_path / n) for n in ("csv", "nd", "csv_out", "nd_out", "audit")]
    keys.add_keys(spark, *paths, run_id="r")
    whole = hashlib.sha1(two.encode()).hexdigest()
    want = [
        f"1_48453_{whole[:10]}",
        f"1_48453_{whole}",
        f"1_48453_{whole}",
        f"2_48453_{whole[:10]}",
        f"1_1_{hashlib.sha1(b'x').hexdigest()[:10]}",
    ]
    csv_rows = spark.read.option("header", True).csv(paths[2])
    assert sorted(r[0] for r in csv_rows.collect()) == sorted(want)
    records = [json.loads(r.value) for r in spark.read.text(paths[3]).collect()]
    assert sorted(r[ROW_KEY_COLUMN] for r in records) == sorted(want)
    shared = spark.read.parquet(f"{paths[4]}/shared_keys").collect()
    assert {(r.key, r.file_kind) for r in shared} == {(want[0], "csv"), (want[0], "ndjson")}


def test_an_owner_keeps_its_key(spark):
    rows = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "a"), ("m", "c"), (None, "d"), ("n", None)], "key string, v string")
    issued = spark.createDataFrame([("k", "b"), ("m", "c")], "key string, owner string")
    for given, owner in ((None, "a"), (issued, "b")):
        found, shared = told_apart(rows, "key", F.col("v"), F.concat(F.lit("wide-"), "v"), given)
        assert [tuple(r) for r in shared.collect()] == [("k", owner)]
        other = {"a": "b", "b": "a"}[owner]
        got = sorted(((r.v, r.key) for r in found.collect()), key=str)
        want = [(owner, "k")] * (2 if owner == "a" else 1) + [(other, f"wide-{other}")] * (2 if other == "a" else 1)
        assert got == sorted([*want, ("c", "m"), ("d", None), (None, "n")], key=str)
    assert conflicts(rows.limit(0), "key", F.col("v")).count() == 0
