"""The driver's queries of this package. Each runs its operator over the whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.llm import (
    chat,
    collocations,
    context_tree,
    decontamination,
    importance,
    jaccard,
    licenses,
    packing,
    pii,
    quality_model,
    quality_rules,
    substring_dedup,
    token_counts,
)
from stormledger.llm.common import table
from stormledger.llm.sql import ORACLES
from stormledger.storage import durable, scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all documents (twice: the second is no change), take the toxic ones down, and
    revise those of low quality to their distinct lines."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    version = "byte_bpe_50k"
    counts = durable(token_counts.counted(docs, TOKENIZER, version))
    toxic = _of(counts, labels.where("toxic = 1"))
    low = labels.where("quality = 0 AND coalesce(toxic, 0) <> 1")
    lines = F.array_join(F.array_distinct(F.split("text", "\n")), "\n")
    after = token_counts.counted(_of(docs, low).withColumn("text", lines), TOKENIZER, version)
    store = token_counts.Rollup(spark, scratch_path(spark, "token-counts"))
    for _ in range(2):
        store.commit("load", token_counts.signed(counts, 1))
    store.commit("takedown", token_counts.signed(toxic, -1))
    store.commit("revision", token_counts.revised(_of(counts, low), after))
    return store.totals()


def _of(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows whose id is chosen; ids are broadcast where they were counted and are few."""
    ids = chosen.select("doc_id").distinct()
    few = ids.count() <= 1_000_000
    return rows.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(
        *("doc_id", "n_words", "n_base", "first_word", "last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "term")

    def number(kind: str) -> Column:
        of_kind = F.filter("spans", lambda s: s["kind"] == kind)
        return F.size(of_kind).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(kind) for kind in pii.KINDS],
        F.sha2(pii.spelled(base), 256).alias("base_sha256"),
        pii.spelled(F.col("spans")).alias("spans"),
    )


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.named(jaccard.classes(docs, words=3, num=90, den=100))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_sample(table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.assemble(rows, TOKENIZER), TOKENIZER)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality_model.score(docs, quality_model.train(docs, labels))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality(table(spark, sf_dir, "documents"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *base, "base_failed", "kept")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = context_tree.in_fold(F.col("doc_id"), 7, 2)
    return context_tree.score(table(spark, sf_dir, "documents"), held_out)


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return importance.resample(docs, target)


def _runnable(query: Callable[[SparkSession, str], DataFrame]):
    """The query, with Python workers told where this package lies, whatever their folder."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
        return query(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: _runnable(f)
    for f in (
        op1_packing,
        op2_token_counts,
        op3_license_scans,
        op4_pii,
        op5_ngram_jaccard,
        op6_decontamination,
        op7_chat_formatting,
        op8_quality_classifier,
        op9_quality_rules,
        op10_substring_dedup,
        op11_lm_scoring,
        op12_phrase_collocations,
        op13_importance_resampling,
    )
}
SQL = {name: ORACLES[name] for name in QUERIES if name in ORACLES}
