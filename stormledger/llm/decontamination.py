"""Benchmark decontamination by winnowing. Native expressions only.

Of every ten consecutive words (a window) the smallest hash of its seven 4-word grams is
kept as a fingerprint, on both sides. Equal windows keep the same gram at the same place in
them, so every shared window, and thus every shared span of ten words or more, meets in a
join of fingerprints. A hit is then extended to the windows around it and compared as a whole.
Texts are read in chunks of a thousand windows, each carrying only word hashes, so that very
long texts make more rows and no larger ones.

The benchmark's side of the join is broadcast only where its windows were counted and are
few; beyond that Spark joins by shuffle and splits skewed fingerprints.

An item of fewer than ten words is one window by itself: it meets the grams of its own
length. Items and documents without words match nothing. Null text has no words. Equal rows
get equal results. Items without id count as hits but are not listed. Empty tables give no
rows, or no hits. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormledger.functions.arrays import let
from stormledger.llm.common import grams, letter_words, text_or_empty, whole_row, word_hashes
from stormledger.storage import durable

WINDOW = 10
GRAM = 4
CHUNK = 1024
BROADCAST_WINDOWS = 500_000  # 24 bytes each
_PLACE = (1 << 11) - 1  # a chunk's places fit into eleven bits
_SPAN = WINDOW - GRAM  # grams in a window, less one


def _hashes(text_column: str) -> Column:
    return word_hashes(letter_words(text_or_empty(text_column)))


def _chunks(rows: DataFrame) -> DataFrame:
    """Rows (keys, hashes) as chunks: the place of the first word, and the hashes."""
    n = F.size("hashes")
    parts = F.transform(
        F.sequence(F.lit(0), n - F.lit(1), F.lit(CHUNK)),
        lambda at: F.struct(
            at.alias("at"),
            F.slice("hashes", at + F.lit(1), F.lit(CHUNK + WINDOW - 1)).alias("h"),
        ),
    )
    keys = [c for c in rows.columns if c != "hashes"]
    return (
        rows.where(n > 0).select(*keys, F.explode(parts).alias("c")).select(*keys, "c.at", "c.h")
    )


def _placed_grams(hashes: Column) -> Column:
    """Gram hashes whose low bits hold their place: the smallest is the first of equals."""
    return F.transform(
        grams(hashes, GRAM),
        lambda h, i: h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("bigint")),
    )


def _minima(placed: Column) -> Column:
    """The fingerprint of every window, in order."""
    return let(
        placed,
        lambda of: F.when(
            F.size(of) > _SPAN,
            F.transform(
                F.sequence(F.lit(1), F.size(of) - F.lit(_SPAN)),
                lambda i: F.array_min(F.slice(of, i, _SPAN + 1)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )


def item_windows(benchmark: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(item_id, words, print, inside, window): each window with its fingerprint's place."""
    items = benchmark.select(
        F.col(id_column).alias("item_id"), _hashes(text_column).alias("hashes")
    )
    n = F.size("hashes")
    short = items.where((n > 0) & (n < WINDOW)).select(
        "item_id",
        n.alias("words"),
        F.lit(None).cast("bigint").alias("print"),
        F.lit(None).cast("int").alias("inside"),
        F.xxhash64(F.lit(0), F.col("hashes")).alias("window"),
    )
    windows = F.arrays_zip(
        _minima(_placed_grams(F.col("h"))).alias("m"), grams(F.col("h"), WINDOW).alias("w")
    )
    long = (
        _chunks(items.where(n >= WINDOW))
        .select("item_id", F.posexplode(windows).alias("i", "x"))
        .select(
            "item_id",
            F.lit(WINDOW).alias("words"),
            F.col("x.m").bitwiseAND(F.lit(~_PLACE)).alias("print"),
            (F.col("x.m").bitwiseAND(F.lit(_PLACE)) - F.col("i")).cast("int").alias("inside"),
            F.col("x.w").alias("window"),
        )
    )
    return durable(long.unionByName(short).distinct())


def _long_hits(chunks: DataFrame, windows: DataFrame, few: bool) -> DataFrame:
    """Documents' places where a ten-word window of an item starts."""
    known = windows.where("words = 10").select("print", "inside", "window").distinct()
    known = F.broadcast(known) if few else known
    prints = F.transform(
        F.array_distinct(_minima(_placed_grams(F.col("h")))),
        lambda m: let(
            m.bitwiseAND(F.lit(_PLACE)).cast("int"),
            lambda p: F.struct(
                m.bitwiseAND(F.lit(~_PLACE)).alias("print"),
                p.alias("p"),
                F.greatest(p - _SPAN, F.lit(0)).alias("from"),
                F.slice(
                    F.col("h"), F.greatest(p - _SPAN, F.lit(0)) + 1, F.lit(2 * WINDOW - GRAM)
                ).alias("near"),
            ),
        ),
    )
    met = (
        chunks.select("doc_id", "text_key", "at", F.explode(prints).alias("f"))
        .select("doc_id", "text_key", "at", "f.*")
        .join(known, "print")
    )
    start = F.col("p") - F.col("inside")
    around = F.slice("near", start - F.col("from") + 1, F.lit(WINDOW))
    same = F.xxhash64(*[F.get(around, F.lit(j)) for j in range(WINDOW)]) == F.col("window")
    return (
        met.where(start >= 0)
        .where((F.size(around) == WINDOW) & same)
        .select(
            "doc_id",
            "text_key",
            (F.col("at") + start).alias("start"),
            F.lit(WINDOW).alias("words"),
            "window",
        )
    )


def _short_hits(chunks: DataFrame, windows: DataFrame, words: int, few: bool) -> DataFrame:
    """Places where an item of this length below ten occurs as a whole."""
    known = windows.where(F.col("words") == words).select("window").distinct()
    known = F.broadcast(known) if few else known
    size = F.size("h")
    starts = F.least(size - words, F.lit(CHUNK - 1))
    made = F.when(
        size >= words,
        F.transform(
            F.sequence(F.lit(0), F.greatest(starts, F.lit(0))),
            lambda i: F.xxhash64(F.lit(0), F.slice(F.col("h"), i + 1, F.lit(words))),
        ),
    )
    return (
        chunks.select("doc_id", "text_key", "at", F.posexplode(made).alias("i", "window"))
        .join(known, "window")
        .select(
            "doc_id",
            "text_key",
            (F.col("at") + F.col("i")).alias("start"),
            F.lit(words).alias("words"),
            "window",
        )
    )


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """One row per contaminated text: its key, number of hit words, and the items' ids."""
    windows = item_windows(benchmark, item_id_column, item_text_column)
    few = windows.count() <= BROADCAST_WINDOWS
    chunks = _chunks(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.xxhash64(text_column).alias("text_key"),
            _hashes(text_column).alias("hashes"),
        )
    )
    found = _long_hits(chunks, windows, few)
    lengths = windows.where(F.col("words") < WINDOW).select("words").distinct().collect()
    for (words,) in sorted(lengths):  # nine at most
        found = found.unionByName(_short_hits(chunks, windows, words, few))
    found = durable(found.distinct())
    key = ["doc_id", "text_key"]
    spans = F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("words")).alias("end"))))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["end"]), F.lit(0))).alias("n"),
            F.greatest(a["end"], s["end"]).alias("end"),
        ),
    )["n"]
    words = found.groupBy(*key).agg(spans.alias("spans")).select(*key, covered.alias("n_hit"), "spans")
    ids = windows.where("item_id IS NOT NULL").select("words", "window", "item_id").distinct()
    ids = F.broadcast(ids) if few else ids
    items = (
        found.select(*key, "words", "window")
        .distinct()
        .join(ids, ["words", "window"])
        .groupBy(*key)
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    return words.join(_renamed(items), _same_key(), "left").drop("k1", "k2")


def _renamed(right: DataFrame) -> DataFrame:
    return right.withColumnRenamed("doc_id", "k1").withColumnRenamed("text_key", "k2")


def _same_key(doc_id: str = "doc_id", text_key: str = "text_key") -> Column:
    return F.col(doc_id).eqNullSafe(F.col("k1")) & (F.col(text_key) == F.col("k2"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, hit words, the items with occurring windows, the spans."""
    sizes = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        F.size(letter_words(text_or_empty("text"))).cast("bigint").alias("n_words"),
    )
    met = sizes.join(_renamed(hits(docs, benchmark)), _same_key(), "left")
    return met.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        "spans",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any hit, with all their columns."""
    rows = docs.select(whole_row(docs).alias("row"))
    found = _renamed(hits(docs, benchmark).select("doc_id", "text_key"))
    same = F.col("row.doc_id").eqNullSafe(F.col("k1")) & (F.xxhash64("row.text") == F.col("k2"))
    return rows.join(found, same, "left_anti").select("row.*")
