"""CSV by chunks, and JSON records changed in place, against Python's csv and json modules."""

from __future__ import annotations

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from stormledger.functions.records import members, with_field
from stormledger.plans.keys import keyed_ndjson
from stormledger.schemas import ROW_KEY_COLUMN
from stormledger.sources import csv_blocks
from stormledger.sources.ndjson import CORRUPT, parse_lines
from stormledger.sources.tabular import read_csv


@pytest.fixture
def small_splits(spark):
    """Files are cut every few hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def a_file(rng, rows):
    def cell():
        if rng.random() < 0.4:
            return "".join(rng.choice('ab,"\n\r x') for _ in range(rng.randint(0, 12)))
        return rng.choice(["", "plain", '5" tall', "x" * rng.randint(1, 40)])

    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n", "\r"]))
    writer.writerow(["id", "A", "b"])
    for i in range(rows):
        writer.writerow([str(i), cell(), cell()])
        out.write(rng.choice(["", "", "\n", 'raw 5" x,"ab" tail,z\r\n', ",\n", '"one\n\n'  '",\n']))
    return out.getvalue()


@pytest.mark.parametrize("chunk_bytes", [1, 150, 1 << 20])
def test_chunks_equal_python(spark, tmp_path, small_splits, chunk_bytes):
    rng = random.Random(chunk_bytes)
    want = {}
    for name, rows in (("a", 60), ("b", 3), ("c", 0)):
        text = a_file(rng, rows) + ('"open to the end, ' if name == "b" else "")
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
        want[f"{name}.csv"] = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    found: dict = {}
    for r in csv_blocks.records(spark, str(tmp_path), chunk_bytes).collect():
        found.setdefault(r.file.rsplit("/", 1)[1], []).append((r.record, r.cells))
    assert {k: sorted(v) for k, v in found.items()} == {k: list(enumerate(v)) for k, v in want.items()}


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    text = "id,note\n" + "".join(f'{i},"line one\nline, two"\n' for i in range(200))
    (tmp_path / "one.csv").write_text(text)
    made = csv_blocks.chunks(spark, str(tmp_path))
    assert made.select("block").distinct().count() > 5
    rows = csv_blocks.read_numbered_csv(spark, str(tmp_path)).orderBy("row_index").collect()
    assert [(r.id, r.note, r.row_index) for r in rows] == [
        (str(i), "line one\nline, two", i) for i in range(200)
    ]
    # Spark's own reader gives the whole file to one task
    assert read_csv(spark, str(tmp_path)).rdd.getNumPartitions() == 1


def test_numbers_across_files_and_odd_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n"a.b",,A.B\n1,2\n3,4,5,6\n')
    (tmp_path / "b.csv").write_text('"a.b",,A.B\n7\n')
    (tmp_path / "c.csv").write_text("")
    rows = csv_blocks.read_numbered_csv(spark, str(tmp_path), across_files=True)
    assert rows.columns == ["a.b0", "_c1", "A.B2", "file", "row_index"]
    found = sorted(tuple(r)[:3] + (r.row_index,) for r in rows.collect())
    assert found == [("1", "2", None, 0), ("3", "4", "5", 1), ("7", None, None, 2)]
    (tmp_path / "d.csv").write_text("other\n1\n")
    with pytest.raises(ValueError, match="more than one header"):
        csv_blocks.read_numbered_csv(spark, str(tmp_path))
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.csv").write_text("\n")
    with pytest.raises(ValueError, match="no header"):
        csv_blocks.read_numbered_csv(spark, str(tmp_path / "none"))


def test_unclosed_quote_is_an_error_beyond_the_bound(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text('a\n"' + "x\n" * 500)
    monkeypatch.setattr(csv_blocks, "RECORD_BYTES", 100)
    with pytest.raises(Exception, match="never closed"):
        csv_blocks.read_numbered_csv(spark, str(tmp_path), chunk_bytes=50).collect()


RECORDS = [
    '{}',
    ' { } ',
    '{"a": 1}',
    '{"k": "old"}',
    '{"a": "k", "meta": {"k": "old"}}',
    '{"k": ["x", "y"], "b": [{"k": 1}, "]"]}',
    '{"k": {"a": "}"}, "z": "\\"}, {"}',
    '{"a":1 , "k" : null , "b":2}',
    '{"k": 1, "a": "x\\\\", "k": 2, "b": 0, "k": 3}',
    '{"\\u006b": "escaped", "a": "\\u006b"}',
    '{"a": {"b": {"c": [[{"k": 1}]]}}, "t": "😀 \\n"}',
]


def test_field_is_set_at_the_top(evaluate):
    made = evaluate(lambda r: with_field(r, "k", F.lit('n"ew\\')), *[r.encode("utf-16", "surrogatepass").decode("utf-16") for r in RECORDS])
    for old, new in zip(RECORDS, made):
        want = json.loads(old)
        want["k"] = 'n"ew\\'
        got = json.loads(new, object_pairs_hook=list)
        assert [k for k, _ in got].count("k") == 1
        assert json.loads(new) == json.loads(json.dumps(want))
        assert [k for k, _ in got] == list(want)  # an old field keeps its place


def test_members_are_kept_as_written(evaluate):
    record = '{"a":1 , "b": {"c":[1,2]},"d":"x,}y" }'
    assert evaluate(members, record) == [['"a":1 ', ' "b": {"c":[1,2]}', '"d":"x,}y" ']]
    wide = "{" + ",".join(f'"f{i}": [{i}]' for i in range(500)) + "}"
    assert len(evaluate(members, wide)[0]) == 500


def test_old_keys_of_any_form_are_replaced(spark, tmp_path):
    parts = '"disasterNumber": 1, "county_fips": "48453", "url": "http://a/b"'
    lines = [
        f'{{{parts}, "meta": {{"{ROW_KEY_COLUMN}": "old"}}}}',
        f'{{"{ROW_KEY_COLUMN}": ["x", "y"], {parts}}}',
        f'{{{parts}}} trailing',
    ]
    (tmp_path / "a.ndjson").write_text("\n".join(lines))
    good, bad = keyed_ndjson(spark, str(tmp_path))
    inside, outside = [json.loads(r.record) for r in good.orderBy("line_index").collect()]
    assert inside["meta"] == {ROW_KEY_COLUMN: "old"}
    assert inside[ROW_KEY_COLUMN] == outside[ROW_KEY_COLUMN]
    assert inside[ROW_KEY_COLUMN].startswith("1_48453_")
    assert [r.line_index for r in bad.collect()] == [2]


def test_lines_are_parsed_once(spark):
    from pyspark.sql import types as T

    lines = spark.range(1).select(F.col("id").cast("string").alias("value"))
    rows = parse_lines(lines, T.StructType.fromDDL("a string, b bigint"))
    plan = rows.where(F.col(CORRUPT).isNull())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_parsed_lists_are_not_copied_and_lines_not_trimmed(spark):
    """What a lambda gives is copied; trimming looks at a line from its end."""
    from pyspark.sql import types as T

    lines = spark.range(1).select(F.col("id").cast("string").alias("value"))
    rows = parse_lines(lines, T.StructType.fromDDL("a array<struct<b: string>>"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "ltrim(" in plan and " trim(" not in plan.replace("ltrim(", "")
