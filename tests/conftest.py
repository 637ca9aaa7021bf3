from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", shared.as_uri())
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Run a Column expression over rows: evaluate(make, (a, b), (c, d)) -> list of results."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    def run(make, *rows, types=None):
        rows = [r if isinstance(r, tuple) else (r,) for r in rows]
        kinds = types or [T.StringType()] * len(rows[0])
        fields = [T.StructField(f"c{i}", k) for i, k in enumerate(kinds)]
        fields.append(T.StructField("n", T.IntegerType()))
        df = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], T.StructType(fields))
        columns = [F.col(f"c{i}") for i in range(len(kinds))]
        return [r[0] for r in df.select(make(*columns).alias("v"), "n").orderBy("n").collect()]

    return run
