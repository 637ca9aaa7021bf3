"""Importance resampling towards a target distribution.

The documents and the target texts (the benchmark) are bags of features, the runs of one and of
two consecutive words, hashed into a fixed number of buckets. A bucket's gain is the logarithm of
how much likelier it is in the target than in the documents; all gains are one array of
``BUCKETS`` numbers, the only thing that tasks are sent, and a document's weight is the mean gain
of its features. Weight plus Gumbel noise, drawn from a hash of the id, is the score: the highest
scores are a draw without replacement in proportion to exp(weight). Scores are ranked by the
radix sort of ``radix``.

Counting and weighing read the texts twice and shuffle only bucket counts; the sort moves a few
numbers per document.

Null text has no words: no features, weight 0, and no place in the draw. Texts are handled a
megabyte at a time, cut between words, so very long ones need no more memory. A null id is
hashed as an empty one and comes after all others in a tie. Rows that repeat an id
have equal noise; those of equal score rank by id, then by fewer features. Ids are whole numbers.
Empty tables give no rows, or gains from the documents alone. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormledger.llm.radix import positions
from stormledger.storage import durable

BUCKETS = 10_000
PERCENT = 25
LEAST_WORDS = 20
SEED = 7
PIECE_BYTES = 1 << 20
_LETTERS = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: Bytes to lower case, and everything that is no word to a space.
_FOLD = bytes(
    b if b >= 0x80 or b in _LETTERS else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def features(text: bytes, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Piece by piece: the number of words, and the bucket of each run that ends in it."""
    at, last = 0, None
    while at < len(text):
        end = at + PIECE_BYTES
        end = text.find(b" ", end) if end < len(text) else -1
        end = end if end >= 0 else len(text)
        words = text[at:end].split()
        at = end
        if not words:
            continue
        ones = list(map(crc32, words))
        # a checksum goes on from that of the word before
        heads = ones[:-1] if last is None else [last, *ones[:-1]]
        tails = words[1:] if last is None else words
        twos = map(crc32, map(b" ".__add__, tails), heads)
        made = np.fromiter((*ones, *twos), np.int64, len(ones) + len(heads))
        last = ones[-1]
        yield len(words), made % buckets


def _folded(texts: pa.Array) -> Iterator[bytes]:
    for text in texts.to_pylist():
        yield (text or "").encode().translate(_FOLD)


def bucket_counts(texts: DataFrame, text_column: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of the whole table fall into each bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in _folded(batch.column(0)):
                for _, found in features(text, buckets):
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"]
        )

    parts = texts.select(text_column).mapInArrow(counted, "bucket bigint, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of every bucket, in thousandths. The driver gets one row per bucket."""
    raw, wanted = ([0] * buckets for _ in range(2))
    for counts, table in ((raw, docs), (wanted, target)):
        for bucket, n in bucket_counts(table, buckets=buckets).collect():
            counts[bucket] = n
    raw_total, wanted_total = sum(raw), sum(wanted)
    return [
        math.floor(
            1000
            * math.log(
                (float(t + 1) * float(raw_total + buckets))
                / (float(s + 1) * float(wanted_total + buckets))
            )
        )
        for s, t in zip(raw, wanted)
    ]


def weigh(docs: DataFrame, gain: list[int], id_column: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    buckets = len(gain)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = np.array(gain, np.int64)
        for batch in batches:
            rows = []
            for text in _folded(batch.column(1)):
                n_words = n = total = 0
                for words, found in features(text, buckets):
                    n_words += words
                    n += len(found)
                    total += int(by_bucket[found].sum())
                rows.append((n_words, n, total // n if n else 0))
            columns = np.array(rows, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    rows = docs.select(F.col(id_column).alias("doc_id"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(weighed, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a hash of seed and id."""
    spelled = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(spelled, 256), 1, 8), 16, 10).cast("bigint")
    uniform = (h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(uniform))).cast("bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank); rank is null for what is not drawn."""
    weights = weigh(docs, gains(docs, target, buckets))
    whole = ("tinyint", "smallint", "int", "bigint")
    if weights.schema["doc_id"].dataType.simpleString() not in whole:
        raise TypeError("ids to rank by must be whole numbers")
    scored = durable(weights.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    keyed = scored.where(F.col("n_words") >= least_words).select(
        *("doc_id", "n_features", "weight", "score"),
        (-F.col("score")).alias("k1"),
        F.col("doc_id").isNull().cast("bigint").alias("k2"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0).cast("bigint")).alias("k3"),
    )
    ordered = positions(keyed, ["k1", "k2", "k3", "n_features"])
    drawn = percent * ordered.count() // 100
    rank = F.when(F.col("position") < drawn, F.col("position") + 1)
    out = ("doc_id", "n_features", "weight", "score")
    rest = scored.where(F.col("n_words") < least_words)
    return ordered.select(*out, rank.alias("rank")).unionByName(
        rest.select(*out, F.lit(None).cast("bigint").alias("rank"))
    )
