"""Runs that are cut short at every step and repeated."""

from __future__ import annotations

import json

import pytest

from stormledger import files
from stormledger.sinks.commits import Output, RunLog


class Cut(Exception):
    """Stands for a driver that dies."""


@pytest.fixture
def outputs(tmp_path):
    return {"rows": Output(str(tmp_path / "rows")), "log": Output(str(tmp_path / "log"), by_run=True)}


def rows_in(spark, tmp_path, name):
    folder = tmp_path / name
    shown = [p for p in folder.rglob("part-*") if "_attempt" not in str(p)] if folder.exists() else []
    return sorted(r.id for r in spark.read.parquet(str(folder)).collect()) if shown else []


def writer(spark, low, high, stop_after=None):
    def write(folder):
        for step, name in enumerate(("rows", "log")):
            if stop_after == step:
                raise Cut
            spark.range(low, high).repartition(3).write.parquet(folder[name])
        if stop_after == 2:
            raise Cut
        return {"rows": high - low}

    return write


@pytest.mark.parametrize("stop_after", [0, 1, 2])
def test_cut_before_the_record(spark, tmp_path, outputs, stop_after):
    log = RunLog(spark, str(tmp_path / "runs"))
    log.run("first", outputs, writer(spark, 0, 4))
    with pytest.raises(Cut):
        log.run("second", outputs, writer(spark, 4, 9, stop_after))
    assert rows_in(spark, tmp_path, "rows") == rows_in(spark, tmp_path, "log") == [0, 1, 2, 3]
    assert [r["run_id"] for r in log.records()] == ["first"]
    for _ in range(2):
        assert log.run("second", outputs, writer(spark, 4, 9)) == {"rows": 5}
    assert rows_in(spark, tmp_path, "rows") == rows_in(spark, tmp_path, "log") == list(range(9))
    assert not list(tmp_path.rglob("_attempt-*"))


@pytest.mark.parametrize("moves", range(6))
def test_cut_after_the_record(spark, tmp_path, outputs, monkeypatch, moves):
    log, made = RunLog(spark, str(tmp_path / "runs")), []
    move = files.move

    def some(*args):
        if len(made) == moves:
            raise Cut
        made.append(args)
        move(*args)

    monkeypatch.setattr(files, "move", some)
    with pytest.raises(Cut):
        log.run("only", outputs, writer(spark, 0, 6))
    monkeypatch.setattr(files, "move", move)
    RunLog(spark, str(tmp_path / "runs")).finish()
    assert rows_in(spark, tmp_path, "rows") == rows_in(spark, tmp_path, "log") == list(range(6))
    assert log.run("only", outputs, writer(spark, 0, 0, stop_after=0)) == {"rows": 6}


def test_of_two_writers_one_commits(spark, tmp_path, outputs):
    log = RunLog(spark, str(tmp_path / "runs"))

    def overtaken(folder):
        other = writer(spark, 0, 3)(folder)
        record = {"run_id": "r", "attempt": "other", "outputs": {}, "totals": {"rows": 99}}
        assert files.write_once(spark, log._record_path("r"), json.dumps(record))
        return other

    assert log.run("r", outputs, overtaken) == {"rows": 99}
    assert rows_in(spark, tmp_path, "rows") == []
    assert not list(tmp_path.rglob("_attempt-*"))


def test_write_once_never_replaces(spark, tmp_path):
    path = f"{tmp_path.as_uri()}/folder/x.json"
    assert files.write_once(spark, path, "one")
    assert not files.write_once(spark, path, "two")
    assert files.read_text(spark, path) == "one"
    assert files.names_in(spark, f"{tmp_path.as_uri()}/folder") == ["x.json"]
    assert files.names_in(spark, str(tmp_path / "nowhere")) == []
