"""The registered queries against their SQL, and the pipeline against brute force."""

from __future__ import annotations

import os

import brute
import oracle
import pytest

import corpus_pipeline
from stormledger.llm.queries import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason=f"no tables at {SF_DIR}")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    assert oracle.differences(found, oracle.connect(SF_DIR), SQL[name]) == []


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_token_counts_query(spark):
    from stormledger.llm.queries import TOKENIZER
    from stormledger.llm.tokens import Encoder

    size = lambda t, e=Encoder(TOKENIZER): len(e.encode(t))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    want: dict = {}
    for d in docs:
        label, text = labels.get(d.doc_id), d.text or ""
        if label and label.toxic == 1:
            continue
        if label and label.quality == 0:
            text = "\n".join(dict.fromkeys(text.split("\n")))
        n, tokens = want.get((d.source, d.lang), (0, 0))
        want[(d.source, d.lang)] = n + 1, tokens + size(text)
    rows = QUERIES["op2_token_counts"](spark, SF_DIR).collect()
    assert {(r.source, r.lang): (r.docs, r.tokens) for r in rows} == want


def test_held_out_quality(spark):
    sf_dir = "/root/testdata/sf0.01"
    if not os.path.isdir(sf_dir):
        pytest.skip("no tables")
    scored = QUERIES["op8_quality_classifier"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    assert wins / (len(good) * len(bad)) > 0.95
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.9


def test_pipeline_stages(spark):
    """Every stage against brute force on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    outs = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        outs.append(stage(spark, outs[-1], SF_DIR).cache())
        assert outs[-1].columns == docs.columns
    raw, good, unique, clean, private = ([(r.doc_id, r.text) for r in x.collect()] for x in outs)
    for d, t in set(raw) - set(good):
        n, *_ = brute.quality_counts(t)
        assert n < 50 or d not in dict(good)
    for d, t in good:
        n, *_, repeated = brute.quality_counts(t)
        assert n >= 50 and 100 * repeated <= 50 * n
    classes = brute.jaccard_classes(good, 5, 4, 5)
    assert sorted(d for d, _ in unique) == sorted({root for _, root in classes.values()})
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    hits = brute.contamination(unique, [(r.item_id, r.text) for r in bench])
    assert sorted(d for d, _ in clean) == sorted(d for d, _ in unique if not hits[d][1])
    assert sorted(d for d, _ in private) == sorted(d for d, _ in clean)
    assert not any(brute.personal(t) for _, t in private)
    before = dict(clean)
    assert all(before[d] == t for d, t in private if not brute.personal(before[d]))


def test_pipeline_run(spark):
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert packed.columns[:7] == (
        "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()
    )
    sums = packed.groupBy("doc_id").sum("length").collect()
    whole = {r.doc_id: r.doc_tokens for r in packed.select("doc_id", "doc_tokens").collect()}
    assert {r[0]: r[1] for r in sums} == whole
