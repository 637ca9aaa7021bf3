"""The positional index against a search through the texts."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from stormledger.operators.phrases import find_phrases
from stormledger.functions.arrays import RUN
from stormledger.operators.positions import PositionalIndex, _places, _postings, _words

WORDS = ["new", "york", "city", "New", "county", "é", "a1"]


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def places(text, phrase):
    own, p = words(text), words(phrase)
    return [i for i in range(len(own) - len(p) + 1) if own[i : i + len(p)] == p] if p else []


def a_text(rng):
    return "".join(rng.choice(WORDS) + rng.choice([" ", ", ", " - "]) for _ in range(rng.randint(0, 60)))


@pytest.fixture
def texts():
    rng = random.Random(3)
    return [(run, i, a_text(rng)) for run in range(3) for i in range(run * 30, run * 30 + 30)] + [
        (2, 990, None),
        (2, 991, "york " * 5000 + "new york"),
    ]


PHRASES = ["new york", "New York, City", "york", "new new", "city new york county", "nowhere", "new nowhere",
           "", "--", "é a1 é", "york york york york york new york"]


def test_phrases_and_places(spark, tmp_path, texts):
    index = PositionalIndex(spark, str(tmp_path), "run int, i int", slots=4, fanout=2)
    for run in (0, 1, 2, 1):
        own = [t for t in texts if t[0] == run]
        index.add(f"run{run}", spark.createDataFrame(own, "run int, i int, text string"), "text")
    assert len(index.segments()) == 2
    asked = spark.createDataFrame([(p,) for p in [*PHRASES, "new york"]], "phrase string")
    got = {(r.i, r.phrase): r.places for r in index.find(asked).collect()}
    want = {(i, p): places(t, p) for _, i, t in texts for p in PHRASES if places(t, p)}
    assert got == want
    # the search through the texts finds the same
    frame = spark.createDataFrame(texts, "run int, i int, text string")
    assert {tuple(r) for r in find_phrases(frame, ["i"], "text", asked).collect()} == set(want)


def test_phrases_are_answered_without_the_texts(spark, tmp_path, texts):
    folder = tmp_path / "texts"
    spark.createDataFrame(texts, "run int, i int, text string").write.parquet(str(folder))
    index = PositionalIndex(spark, str(tmp_path / "index"), "i int", slots=8)
    index.add("all", spark.read.parquet(str(folder)), "text")
    for p in folder.iterdir():
        p.unlink()
    asked = spark.createDataFrame([("new york",)], "phrase string")
    assert index.find(asked).count() == sum(bool(places(t, "new york")) for _, _, t in texts)
    assert index.find(asked.where(F.lit(False))).count() == 0


def test_an_empty_index(spark, tmp_path):
    index = PositionalIndex(spark, str(tmp_path), "i int")
    asked = spark.createDataFrame([("new york",)], "phrase string")
    assert index.find(asked).count() == 0
    index.add("none", spark.createDataFrame([], "i int, text string"), "text")
    index.add("null", spark.createDataFrame([(1, None), (2, " .")], "i int, text string"), "text")
    assert index.find(asked).count() == 0


def test_postings_of_a_frequent_word_take_linear_time(spark):
    n = 150_000
    text = F.concat(F.lit("the "), F.repeat(F.lit("york "), n - 2), F.lit("the"))
    began = time.monotonic()
    posting = spark.range(1).select(F.explode(_postings(_words(text))).alias("p")).select("p.*")
    got = {r.word: (r.first, r.n, r.sum) for r in posting.selectExpr(
        "word", "steps[0] AS first", "size(steps) AS n", "aggregate(steps, 0, (a, b) -> a + b) AS sum").collect()}
    assert got == {"the": (1, 2, n), "york": (2, n - 2, n - 1)}
    assert time.monotonic() - began < 30


@pytest.mark.parametrize("n", [1, 2, RUN, RUN + 1, 3 * RUN + 5])
def test_places_of_any_number_of_steps(spark, n):
    steps = [random.Random(n).randint(1, 9) for _ in range(n)]
    made = spark.createDataFrame([(steps, 2)], "steps array<int>, back int")
    got = made.select(_places(F.col("steps"), F.col("back"))).first()[0]
    assert got == [sum(steps[: i + 1]) - 3 for i in range(n)]
