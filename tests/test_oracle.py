"""Every named query against its SQL."""

from __future__ import annotations

import os

import oracle
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from stormledger.catalog import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason=f"no tables at {SF_DIR}")


@pytest.fixture(scope="module")
def tables():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tables, name):
    assert oracle.differences(queries()[name](spark, SF_DIR), tables, oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= queries().keys() and SQL.keys() <= oracle_sql().keys()


def test_entry(spark):
    flagship = entry(spark)
    assert len(flagship.columns) == 16 and flagship.count() > 0


def test_dedup_orders_differ(spark):
    before, after = (
        {tuple(r) for r in queries()[n](spark, SF_DIR).collect()}
        for n in ("dedup_before_filter", "dedup_after_filter")
    )
    assert before != after and before < after


def test_row_keys_are_unique_per_event_and_url(spark):
    from pyspark.sql import functions as F

    from stormledger.catalog.expressions import event_url

    made = queries()["row_key"](spark, SF_DIR)
    parts = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").select(
        "l_orderkey", "l_suppkey", event_url().alias("url")
    )
    assert made.select("key").distinct().count() == parts.distinct().count()
    assert made.where(~F.col("key").rlike(r"^\d+_\d{5,}_[0-9a-f]{10}$")).count() == 0
