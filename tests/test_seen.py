"""The index of seen URLs against keep-first over all runs together."""

from __future__ import annotations

import random

import pytest

from stormledger.operators import seen
from stormledger.operators.seen import SeenUrls
from stormledger.operators.segments import Segments


def batches(seed, runs, rows, urls):
    rng = random.Random(seed)
    return [
        [(rng.choice([None, "", *(f"http://h/{rng.randrange(urls)}?{i}" for _ in range(8))]), run, i)
         for i in range(rows)]
        for run in range(runs)
    ]


def first_of_each(runs):
    out = {}
    for rows in runs:
        for url, run, i in rows:
            out.setdefault(url if url is None else url.split("?")[0], (url, run, i))
    return sorted(out.values(), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "url string, run int, i int").repartition(3)


def test_runs_equal_one_batch(spark, tmp_path):
    runs = batches(1, 5, 60, 150)
    index = SeenUrls(spark, str(tmp_path), slots=4, fanout=2)
    got = [tuple(r) for n, rows in enumerate(runs) for r in index.add(f"r/{n}", frame(spark, rows), "url", "i").collect()]
    assert sorted(got, key=str) == first_of_each(runs)
    assert len(index.segments()) == 2  # of five runs: four merged twice, and the last
    again = index.add("r/1", frame(spark, runs[0]), "url", "i").collect()
    assert sorted(map(tuple, again), key=str) == sorted((t for t in got if t[1] == 1), key=str)


def test_a_batch_of_new_urls_opens_nothing(spark, tmp_path):
    index = SeenUrls(spark, str(tmp_path), slots=8)
    for n in range(3):
        rows = [(f"http://{n}/{i}", n, i) for i in range(20)]
        assert index.add(str(n), frame(spark, rows), "url", "i").count() == 20
        assert index.opened == []
    one = frame(spark, [("http://1/7?again", 9, 0), ("http://new/", 9, 1)])
    assert [r.url for r in index.add("last", one, "url", "i").collect()] == ["http://new/"]
    assert [segment for segment, _ in index.opened] == ["1"]


def test_equal_hashes_of_different_urls(spark, tmp_path, monkeypatch):
    """Filters and hashes only say where to look."""
    monkeypatch.setattr(seen.F, "xxhash64", lambda *c: seen.F.lit(5).cast("bigint"))
    index = SeenUrls(spark, str(tmp_path), slots=2)
    assert index.add("a", frame(spark, [("x", 0, 0), (None, 0, 1)]), "url", "i").count() == 2
    left = index.add("b", frame(spark, [("x?1", 1, 0), ("y", 1, 1), (None, 1, 2)]), "url", "i")
    assert [r.url for r in left.collect()] == ["y"]


@pytest.mark.parametrize("step", [1, 2, 3])
def test_a_run_cut_short_is_not_seen(spark, tmp_path, monkeypatch, step):
    class Cut(Exception):
        pass

    index, calls = SeenUrls(spark, str(tmp_path), slots=2), []
    index.add("a", frame(spark, [("x", 0, 0)]), "url", "i")
    owner, name = {
        1: (SeenUrls, "_known"),
        2: (SeenUrls, "_write_segment"),
        3: (Segments, "merge_levels"),
    }[step]
    whole = getattr(owner, name)

    def cut(self, *args):
        if not calls:
            calls.append(name)
            raise Cut
        return whole(self, *args)

    monkeypatch.setattr(owner, name, cut)
    batch = frame(spark, [("x", 1, 0), ("y", 1, 1)])
    with pytest.raises(Cut):
        index.add("b", batch, "url", "i")
    assert [r.url for r in index.add("b", batch, "url", "i").collect()] == ["y"]
    assert index.add("c", batch, "url", "i").count() == 0


def test_empty_runs(spark, tmp_path):
    index = SeenUrls(spark, str(tmp_path), slots=2, fanout=2)
    for n in range(3):
        assert index.add(str(n), frame(spark, []), "url", "i").count() == 0
    assert index.add("x", frame(spark, [("u", 0, 0)]), "url", "i").count() == 1
