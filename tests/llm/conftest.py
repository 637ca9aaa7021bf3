from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Names that the operators use inside, as further columns of the input.
CLASHES = "block bin q row start words sig spans k1 k2 text_key n hashes token kept meta.x".split()


@pytest.fixture
def documents(spark):
    """Make a documents table, with every clashing name as one more column."""

    def make(rows, lang="en", source="s", parts=3):
        kinds = [("doc_id", T.LongType()), ("text", T.StringType())]
        kinds += [(c, T.StringType()) for c in ("lang", "source")]
        kinds += [("n_chars", T.LongType())]
        kinds += [(c, T.StringType()) for c in CLASHES]
        schema = T.StructType([T.StructField(n, k) for n, k in kinds])
        full = [(d, t, lang, source, len(t or ""), *CLASHES) for d, t in rows]
        return spark.createDataFrame(full, schema).repartition(parts)

    return make


LONG = "ab cd " * 40_000


@pytest.fixture
def odd_rows():
    """Null id, null, empty and blank texts, repeated rows, equal ids, a very long text."""
    text = "one two three four five six seven eight nine ten eleven twelve " * 6
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, text),
        (4, text),
        (4, "other words under one id"),
        (None, text),
        (None, None),
        (5, text),
        (6, LONG),
        (7, "\U0001f600 é \x00 x"),
    ]
