"""Sources and sinks on small files."""

from __future__ import annotations

import csv
import gzip
import io
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormledger import storage
from stormledger.schemas import ARTICLE, ARTICLE_CSV_COLUMNS
from stormledger.sinks import writers
from stormledger.sources import lines, ndjson, payloads, tabular


def written_lines(folder):
    return [
        line
        for part in sorted(folder.glob("part-*"))
        for line in part.read_text(encoding="utf-8").splitlines()
    ]


def test_alias_order_and_missing_columns(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        'State ,county,CountyClean,STATE_FIPS\n" Texas ",x,Travis,48\n"",y,Gone,1\nOhio,z\n'
    )
    rows = tabular.read_counties(spark, str(tmp_path / "c.csv")).collect()
    assert [(r.row_index, r.state_name, r.county_name_clean, r.state_fips) for r in rows] == [
        (0, "Texas", "Travis", "48")
    ]
    (tmp_path / "bad.csv").write_text("state,other\nTexas,1\n")
    with pytest.raises(ValueError, match="county_name_clean"):
        tabular.read_counties(spark, str(tmp_path / "bad.csv"))


def test_done_keys(spark, tmp_path):
    nothing = [str(tmp_path / "absent.csv")]
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "other.csv").write_text("state,county\nTexas,Travis\n")
    nothing += [str(tmp_path / "empty.csv"), str(tmp_path / "other.csv")]
    for path in nothing:
        keys = tabular.read_done_keys(spark, path)
        assert keys.columns == ["state", "county", "disaster"] and keys.count() == 0
    (tmp_path / "log.csv").write_text(
        "County,STATE,disaster,date_groups,articles\n"
        "Powell , Montana,earthquake,0,0\nPowell,Montana,earthquake,3,9\n,Ohio,flood,0,0\n"
    )
    keys = tabular.read_done_keys(spark, str(tmp_path / "log.csv")).collect()
    assert [tuple(k) for k in keys] == [("Montana", "Powell", "earthquake")]


MALFORMED = '{"a": 1}\n\n   \n{"a": \nnot json\n{"a": 2, "b": "é"}\n'


def test_ndjson(spark, tmp_path):
    schema = T.StructType.fromDDL("a bigint, b string")
    (tmp_path / "x.ndjson").write_text(MALFORMED, encoding="utf-8")
    good, bad = ndjson.read_ndjson_tolerant(spark, str(tmp_path / "x.ndjson"), schema)
    assert sorted(tuple(r) for r in good.collect()) == [(1, None), (2, "é")]
    assert sorted(r[0] for r in bad.collect()) == ["not json", '{"a": ']
    with pytest.raises(Exception, match="MALFORMED|alformed"):
        ndjson.read_ndjson(spark, str(tmp_path / "x.ndjson"), schema).collect()


LINES = [
    '{"a": 1}', '{"a": 1} trailing', '{"a": 1}]', '{"a": 1},{"b": 2}', '{"a": 1},0', "[1]", "1", '"{x"',
    ' {"a": "4332", "b": "x]}", "c": {"d": [1, 2]}} ', '{"a": null}', "{}", '{"a": 1}}', '{"a": 1,}',
    "null", '{"a": "open', "{'a': 1}", '{"a": 01}', '{"a": 1}#c', '{"a": 1.5}', '{"a": true}',
]


def test_one_object_per_line(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    schema = T.StructType.fromDDL("a bigint, b string")
    rows = ndjson.parse_lines(lines.withColumn("line", F.col("value")), schema).collect()

    def is_object(text):
        try:
            return isinstance(json.loads(text), dict)
        except ValueError:
            return False

    got = {r.line: (r._corrupt_record is None, r.a) for r in rows}
    assert {x: ok for x, (ok, _) in got.items()} == {x: is_object(x) for x in LINES}
    assert got[LINES[8]][1] == 4332 and got['{"a": 1.5}'] == (True, None)


def test_number_lines_over_many_blocks(spark, tmp_path):
    texts = {"a": [f"line {i}" if i % 3 else "" for i in range(500)], "b": ["x"] * 37}
    for name, content in texts.items():
        (tmp_path / f"{name}.txt").write_text("\n".join(content) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        rows = lines.number_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, content in texts.items():
        mine = sorted((r.line_index, r.value) for r in rows if r.file.endswith(f"{name}.txt"))
        assert mine == list(enumerate(content))


def test_line_counts(spark, tmp_path):
    (tmp_path / "x.csv").write_text("h\n\n  \t\na\nb\n")
    text = spark.read.text(str(tmp_path / "x.csv"))
    assert lines.count_lines(text).first()[0] == 3
    assert lines.count_csv_rows(text).first()[0] == 2
    (tmp_path / "e.csv").write_text("")
    assert lines.count_csv_rows(spark.read.text(str(tmp_path / "e.csv"))).first()[0] == 0


def test_header_row_json_is_positional(spark):
    df = spark.createDataFrame([("06", '[["b","a"],["Kern","6"],["Napa",null]]'), ("07", "[]")], "s string, v string")
    rows = payloads.header_row_json(df, F.col("v"), ["name", "code"], "s").collect()
    assert [tuple(r) for r in rows] == [("06", 1, "Kern", "6"), ("06", 2, "Napa", None)]


def test_article_payload_fallback(spark):
    schema = "id int, articles array<struct<title: string>>, timeline array<struct<title: string>>"
    df = spark.createDataFrame(
        [(1, [("a",), ("b",)], [("t",)]), (2, [], [("t",)]), (3, None, [("u",)]), (4, None, None), (5, [], [])],
        schema,
    )
    rows = payloads.explode_articles(df, "id").collect()
    assert sorted(tuple(r) for r in rows) == [(1, 0, "a"), (1, 1, "b"), (2, 0, "t"), (3, 0, "u")]


def test_csv_payload(spark):
    text = (
        'Date,Title,DocumentIdentifier,Other\r\n'
        '20240110120000,"Rain, ""heavy""\nand wind",http://a/1,x\r\n'
        '\r\n'
        'bad,,http://a/2\r\n'
        '20240111,"",http://a/3,"q"'
    )
    df = spark.createDataFrame(
        [("k", text), ("no", "Link,Title\nx,y\n"), ("head", "DocumentIdentifier,Title\n"), ("none", None)],
        "k string, t string",
    )
    fields = ["DocumentIdentifier", "Date", "Title", "SourceCommonName"]
    rows = payloads.csv_payload_rows(df, "t", fields, "k").orderBy("article_pos").collect()
    assert [tuple(r) for r in rows] == [
        ("k", 0, "http://a/1", "20240110120000", 'Rain, "heavy"\nand wind', None),
        ("k", 1, "http://a/2", "bad", "", None),
        ("k", 2, "http://a/3", "20240111", "", None),
    ]
    want = list(csv.DictReader(text.splitlines(keepends=True)))
    assert [r.Title for r in rows] == [w["Title"] for w in want]


def test_csv_payload_equals_python(spark):
    rng = random.Random(1)
    parts = ['"', '""', ",", "\n", "\r\n", "a", "b 5", " ", '"x,y"', '"p\r\nq"', '"t""u"', "é"]
    texts = []
    for _ in range(300):
        body = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        texts.append("DocumentIdentifier,Title,Date\r\n" + body)
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    fields = ["DocumentIdentifier", "Title", "Date"]
    got = {k: [] for k in range(len(texts))}
    for r in payloads.csv_payload_rows(df, "t", fields, "k").orderBy("k", "article_pos").collect():
        got[r.k].append(tuple(r)[2:])
    for k, text in enumerate(texts):
        rows = csv.DictReader(io.StringIO(text, newline=""))
        assert got[k] == [tuple(r[f] for f in fields) for r in rows], repr(text)


def test_long_csv_payload(spark):
    cell = '"' + 'x""y,\n' * 20_000 + '"'
    text = "DocumentIdentifier,Title\n" + f"http://a,{cell}\n" + "b,c\n" * 20_000
    df = spark.createDataFrame([(text,)], "t string")
    rows = payloads.csv_payload_rows(df, "t", ["DocumentIdentifier", "Title"])
    assert rows.count() == 20_001 and len(rows.where("article_pos = 0").first().Title) == 100_000


def test_payload_acceptance(spark):
    long = "DocumentIdentifier" + "x" * 100
    df = spark.createDataFrame([(long, 200), (long, 429), ("DocumentIdentifier", 200), (None, 200)], "t string, s int")
    kept = df.where(payloads.usable_payload(F.col("t"), F.col("s"), min_length=100))
    assert kept.count() == 1


AWKWARD = [("1", ' lead, "quoted" \\ back'), ("2", ""), ("3", "two\nlines"), ("4", None), ("5", "é — ü")]


def test_csv_sink_reads_back_in_python(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, "k string, v string").coalesce(1)
    writers.write_csv(df, str(tmp_path / "out"))
    [part] = (tmp_path / "out").glob("part-*")
    with part.open(newline="", encoding="utf-8") as handle:
        rows = [(r["k"], r["v"]) for r in csv.DictReader(handle)]
    assert rows == [(k, v or "") for k, v in AWKWARD]
    assert '""' not in part.read_text().splitlines()[2]
    back = tabular.read_csv(spark, str(tmp_path / "out")).collect()
    assert sorted((r.k, r.v or "") for r in back) == [(k, v or "") for k, v in AWKWARD]


def test_ndjson_sink_keeps_nulls_and_letters(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, "k string, v string")
    writers.append_ndjson(df, str(tmp_path / "out"))
    writers.append_ndjson(df.where("k = '4'"), str(tmp_path / "out"))
    records = [json.loads(line) for line in written_lines(tmp_path / "out")]
    assert len(records) == 6 and records.count({"k": "4", "v": None}) == 2
    assert any("é — ü" in line for line in written_lines(tmp_path / "out"))


@pytest.mark.parametrize("rows", [0, 1, 25, 12_000])
def test_json_array(spark, tmp_path, rows):
    df = spark.range(rows).select(F.col("id").alias("pos"), (F.col("id") * 2).alias("v"))
    writers.write_json_array(df.repartition(5), str(tmp_path / "out"), "pos")
    lines = written_lines(tmp_path / "out")
    assert json.loads("\n".join(lines)) == [{"v": 2 * i} for i in range(rows)]
    assert len(lines) == max(1, rows)


def test_audit_run_is_replaced_not_doubled(spark, tmp_path):
    for run in ("r1", "r2", "r2"):
        writers.write_audit(spark.range(3), str(tmp_path), run)
    counts = spark.read.parquet(str(tmp_path)).groupBy("run_id").count().collect()
    assert sorted(tuple(r) for r in counts) == [("r1", 3), ("r2", 3)]


def test_dual_sink(spark, tmp_path):
    row = [7] + ["a,b"] * 12 + [2] + ["why", "label", "query"]
    writers.write_articles(
        spark.createDataFrame([tuple(row)], ARTICLE), str(tmp_path / "n"), str(tmp_path / "c")
    )
    [record] = [json.loads(line) for line in written_lines(tmp_path / "n")]
    assert list(record) == ARTICLE.names and record["gdelt_query"] == "query"
    [only] = tabular.read_csv(spark, str(tmp_path / "c")).collect()
    assert only.asDict().keys() == set(ARTICLE_CSV_COLUMNS) and only.title == "a,b"


def test_run_folder_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_dir", lambda _: tmp_path.as_uri())
    assert storage.durable(spark.range(3)).count() == 3
    [kept] = (tmp_path / "stormledger").iterdir()
    storage.drop_run_folder(spark)
    assert not kept.exists()


def test_packed_ndjson_is_gzipped_in_files_of_bounded_length(spark, tmp_path):
    df = spark.range(25).select("id", F.lit("é, " * 200).alias("v")).coalesce(1)
    for _ in range(2):
        writers.append_ndjson(df, str(tmp_path / "out"), packed=10)
    parts = [len(gzip.open(p, "rt", encoding="utf-8").readlines()) for p in (tmp_path / "out").glob("*.json.gz")]
    assert sorted(parts) == [5, 5, 10, 10, 10, 10]
    assert sum(p.stat().st_size for p in (tmp_path / "out").iterdir()) < 50 * 600 / 4
    back = ndjson.read_ndjson(spark, str(tmp_path / "out"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(2 * [*map(tuple, df.collect())])


def test_packed_lines_are_gzipped_in_files_of_bounded_length(spark, tmp_path):
    texts = spark.range(25).select(F.concat(F.lit("é "), F.col("id").cast("string")).alias("value")).coalesce(1)
    for _ in range(2):
        writers.append_lines(texts, str(tmp_path / "out"), packed=10)
    files = [gzip.open(p, "rt", encoding="utf-8").read().splitlines() for p in (tmp_path / "out").glob("*.gz")]
    assert sorted(map(len, files)) == [5, 5, 10, 10, 10, 10]
    assert sorted(x for f in files for x in f) == sorted(2 * [f"é {i}" for i in range(25)])
