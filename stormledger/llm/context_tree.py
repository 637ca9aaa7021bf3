"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions, first bit first. Each decision has a tree of contexts: the bits
of its byte so far, after the last 0, 1, ... ``DEPTH`` bytes. Every node estimates the next bit by
Krichevsky and Trofimov from the zeros and ones seen there in training, and the tree mixes the
estimates of all depths: a node's weight against its children is set by how well either coded
the training text. The score is the logarithm of the product over all bits of a text and its end;
per byte and to base two it is the code length.

1. All tasks count the words and the grams (``DEPTH`` bytes and the next one) of their texts, once
   per distinct one. Grams that only held-out texts have come with zero, which changes no other
   node and gives them a place in the tree.
2. The tree is built from the leaves up, by one aggregation per depth, and mixed from the root
   down, by one join per depth. Every gram then has one number, the logarithm of the next byte's
   probability. Words have their counts, for the unigram base.
3. Texts are dealt over blocks of some ``BLOCK_BYTES``. A block asks once for each distinct word and
   gram it holds, gets the answers by a join, and sums them over its texts. So what moves follows
   the distinct keys of blocks; no task or driver holds the model.

Texts are in lower case (A-Z alone); null is empty. They are read in pieces of a megabyte, so very
long ones need no more memory beside themselves. Rows of one id and text fall into one block for
each task that reads them, so that repeated rows spread as their tasks do. A null id is hashed
as an empty string. Without any training text all counts are zero and every bit has one half. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormledger.llm.counters import Run, added, tallied
from stormledger.llm.fingerprints import word_hashes
from stormledger.storage import durable

DEPTH = 4
BLOCK_BYTES = 24 << 20
PIECE_BYTES = 1 << 20
HELD = 1 << 21  # counters that a task holds before it sends them
END = b"\xff"  # in no UTF-8 text: ends every text, and stands before it
_WORD = np.uint64(1 << 63)  # marks the keys of words; those of grams are below 2 ** 40
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def folded(texts: pa.Array) -> list[bytes]:
    return [(t or "").encode().translate(_LOWER) for t in texts.to_pylist()]


def word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all words in order, and where each text's words begin (len + 1 offsets)."""
    hashes, offsets = word_hashes(texts)
    return hashes | _WORD, offsets


def gram_keys(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text's number, key) of all grams, about a megabyte at a time."""
    pieces, owners, size = [], [], 0
    for number, text in enumerate(texts):
        whole = END * DEPTH + text + END
        for at in range(DEPTH, len(whole), PIECE_BYTES):
            pieces.append(whole[at - DEPTH : at + PIECE_BYTES])
            owners.append(number)
            size += len(pieces[-1])
            if size >= PIECE_BYTES:
                yield _packed(pieces, owners)
                pieces, owners, size = [], [], 0
    if pieces:
        yield _packed(pieces, owners)


def _packed(pieces: list[bytes], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint64)
    keys = data.copy()
    for back in range(1, DEPTH + 1):
        keys[back:] |= data[:-back] << np.uint64(8 * back)
    lengths = np.array([len(p) for p in pieces])
    inside = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    new = inside >= DEPTH
    return np.repeat(owners, lengths)[new], keys[new]


def gram_places(known: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Where the grams stand among the sorted known keys; neighbouring look-ups are near by then.

    Grams leave the upper bits free, so that sorting them with their places takes one plain sort.
    """
    bits = np.uint64(64 - 8 * (DEPTH + 1))
    order = np.sort(grams << bits | np.arange(len(grams), dtype=np.uint64))
    places = np.empty(len(grams), np.int64)
    places[order & ((np.uint64(1) << bits) - np.uint64(1))] = np.searchsorted(known, order >> bits)
    return places


def counts(docs: DataFrame) -> DataFrame:
    """(key, n) of all words and grams of rows (learn, text): how often training has them."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[Run] = []

        def sent() -> pa.RecordBatch:
            keys, n = added(runs)
            runs.clear()
            columns = [pa.array(keys.view(np.int64)), pa.array(n, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["key", "n"])

        for batch in batches:
            texts = folded(batch.column(1))
            learnt = batch.column(0).to_pylist()
            for learn in (1, 0):
                some = [t for t, of in zip(texts, learnt) if of == learn]
                keys, n = tallied(word_keys(some)[0])
                runs.append((keys, n * learn))
                for _, grams in gram_keys(some):
                    keys, n = tallied(grams)
                    runs.append((keys, n * learn))
                    if sum(len(k) for k, _ in runs) >= HELD:
                        runs[:] = [added(runs)]
                        if len(runs[0][0]) >= HELD // 2:
                            yield sent()
        if runs:
            yield sent()

    parts = docs.select("learn", "text").mapInArrow(counted, "key bigint, n bigint")
    return durable(parts.groupBy("key").agg(F.sum("n").alias("n")))


def ln_gamma(x: Column) -> Column:
    """Stirling's series, eight steps up, where it is exact to about twelve digits."""
    y = x + 8
    product = x
    for i in range(1, 8):
        product = product * (x + i)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + series - F.ln(product)


def ln_estimate(zeros: Column, ones: Column) -> Column:
    """Logarithm of the Krichevsky-Trofimov probability of a sequence of so many zeros and ones."""
    a, b = zeros.cast("double"), ones.cast("double")
    value = ln_gamma(a + 0.5) + ln_gamma(b + 0.5) - ln_gamma(a + b + 1) - math.log(math.pi)
    return F.when(a + b == 0, F.lit(0.0)).otherwise(value)


def _bits(grams: DataFrame) -> DataFrame:
    """Every gram's eight decisions: the node (context, bits so far with a one before them), the bit."""
    step = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("step")
    return grams.select("*", step).select(
        "*",
        F.expr(
            "shiftleft(shiftright(key, 8), 8)"
            " | shiftleft(1L, step) | shiftright(key & 255, 8 - step)"
        ).alias("node"),
        F.expr("shiftright(key, 7 - step) & 1").alias("bit"),
    )


def _parent(node: Column, depth: int) -> Column:
    """The node of the same bits whose context is one byte shorter, so ``depth`` bytes long."""
    return node.bitwiseAND(F.lit((1 << 8 * (depth + 1)) - 1))


def trees(grams: DataFrame) -> list[DataFrame]:
    """Per depth, (node, zeros, ones, own, below): log-probabilities of the training bits that pass
    a node, by its own estimate and by the children's mixture."""
    level = (
        _bits(grams)
        .groupBy("node")
        .agg(
            F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("zeros"),
            F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("ones"),
        )
        .select("*", ln_estimate(F.col("zeros"), F.col("ones")).alias("own"))
    )
    levels = [durable(level.withColumn("below", F.lit(None).cast("double")))]
    for depth in range(DEPTH - 1, -1, -1):
        gap = F.abs(F.col("own") - F.col("below"))
        half = F.greatest("own", "below") + F.log1p(F.exp(-gap)) - math.log(2)
        level = (
            levels[0]
            .select(
                _parent(F.col("node"), depth).alias("node"),
                *("zeros", "ones", F.coalesce(half, "own").alias("mixed")),
            )
            .groupBy("node")
            .agg(
                F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("mixed").alias("below")
            )
            .select("node", "zeros", "ones", ln_estimate(F.col("zeros"), F.col("ones")).alias("own"), "below")
        )
        levels.insert(0, durable(level))
    return levels


def probabilities(levels: list[DataFrame]) -> DataFrame:
    """(node, zero, one): the mixture's probability of either bit at the deepest nodes."""
    mixed = None
    for depth, level in enumerate(levels):
        # the node's share in the mixture of itself and what lies below; all of it at the end
        share = F.coalesce(1 / (1 + F.exp(F.col("below") - F.col("own"))), F.lit(1.0))
        rest = F.coalesce(1 / (1 + F.exp(F.col("own") - F.col("below"))), F.lit(0.0))
        seen = F.col("zeros") + F.col("ones") + 1
        level = level.select(
            "node",
            *(share.alias("share"), rest.alias("rest")),
            ((F.col("zeros") + 0.5) / seen).alias("p0"),
            ((F.col("ones") + 0.5) / seen).alias("p1"),
        )
        if mixed is None:
            above = level.select(
                "*", F.lit(1.0).alias("left"), F.lit(0.0).alias("zero"), F.lit(0.0).alias("one")
            )
        else:
            above = level.withColumn("up", _parent(F.col("node"), depth - 1)).join(
                mixed.withColumnRenamed("node", "up"), "up"
            )
        mixed = above.select(
            "node",
            (F.col("left") * F.col("rest")).alias("left"),
            (F.col("zero") + F.col("left") * F.col("share") * F.col("p0")).alias("zero"),
            (F.col("one") + F.col("left") * F.col("share") * F.col("p1")).alias("one"),
        )
    return mixed.select("node", "zero", "one")


def costs(grams: DataFrame) -> DataFrame:
    """(key, cost): the logarithm of the probability of a gram's last byte after the others."""
    bits = _bits(grams.select("key")).select("key", "node", "bit")
    chance = F.when(F.col("bit") == 0, F.col("zero")).otherwise(F.col("one"))
    found = bits.join(probabilities(trees(grams)), "node")
    return found.groupBy("key").agg(F.sum(F.ln(chance)).alias("cost"))


def _requests(dealt: DataFrame) -> DataFrame:
    """(block, key): every distinct word and gram of each block."""

    def asked(table: pa.Table) -> pa.Table:
        runs: list[Run] = []
        for batch in table.to_batches():
            texts = folded(batch.column("text"))
            runs.append(tallied(word_keys(texts)[0]))
            for _, keys in gram_keys(texts):
                runs.append(tallied(keys))
                if sum(len(k) for k, _ in runs) >= HELD:
                    runs = [added(runs)]
        keys = added(runs)[0].view(np.int64)
        block = table.column("block")[0].as_py()
        return pa.table({"block": pa.array([block] * len(keys), pa.int64()), "key": keys})

    return dealt.groupBy("block").applyInArrow(asked, "block bigint, key bigint")


def _summed(
    dealt: DataFrame, answers: DataFrame, train_docs: int, train_tokens: int, distinct: int
) -> DataFrame:
    """The scores of all texts, block by block, from the answers (block, key, n, cost)."""
    whole = train_tokens + distinct + 1
    end_log, end_known = math.log10((train_docs + 1) / whole), int(train_docs > 0)

    def scored(texts: pa.Table, known: pa.Table) -> pa.Table:
        keys = known.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        keys = keys[order]
        n = known.column("n").to_numpy()[order]
        cost = known.column("cost").to_numpy()[order]
        logs = np.log10((n + 1) / whole)
        out = []
        for batch in texts.to_batches():
            data = folded(batch.column("text"))
            words, offsets = word_keys(data)
            at = np.searchsorted(keys, words)
            owner = np.repeat(np.arange(len(data)), np.diff(offsets))
            base = np.bincount(owner, logs[at], len(data)) + end_log
            met = np.bincount(owner, n[at] > 0, len(data)).astype(np.int64) + end_known
            total = np.zeros(len(data))
            for owners, grams in gram_keys(data):
                total += np.bincount(owners, cost[gram_places(keys, grams)], len(data))
            size = np.array([len(t) + 1 for t in data])
            columns = [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(np.diff(offsets) + 1, pa.int64()),
                pa.array(met, pa.int64()),
                pa.array(np.full(len(data), train_tokens), pa.int64()),
                pa.array(base, pa.float64()),
                pa.array(total / math.log(10), pa.float64()),
                pa.array(-total / math.log(2) / size, pa.float64()),
            ]
            out.append(pa.RecordBatch.from_arrays(columns, names))
        return pa.Table.from_batches(out)

    names = (
        "doc_id held_out n_tokens n_known train_tokens base_score score bits_per_byte"
    ).split()
    kind = dealt.schema["doc_id"].dataType.simpleString()
    return (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            scored,
            f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
            "base_score double, score double, bits_per_byte double",
        )
    )


def score(docs: DataFrame, held_out: Column, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte).

    Learns from the rows that ``held_out`` does not hold for, and scores all. ``base_score`` is
    that of single words with add-one smoothing; all scores but the last are to base ten.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), "text", held_out.alias("held_out"))
    learn = (~F.col("held_out")).cast("bigint").alias("learn")
    total = rows.agg(
        F.sum(F.octet_length("text")).alias("size"), F.sum(learn).alias("learnt")
    ).first()
    train_docs = total.learnt or 0
    seen = counts(rows.select(learn, "text"))
    words, grams = seen.where("key < 0"), seen.where("key >= 0")
    known = words.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    model = durable(
        words.select("key", "n", F.lit(0.0).alias("cost")).unionByName(
            costs(grams).select("key", F.lit(0).cast("bigint").alias("n"), "cost")
        )
    )
    place = F.xxhash64("doc_id", "text", F.spark_partition_id())
    blocks = 1 + (total.size or 0) // BLOCK_BYTES
    dealt = rows.select("*", F.pmod(place, F.lit(blocks)).alias("block"))
    answers = _requests(dealt).join(model, "key").select("block", "key", "n", "cost")
    return _summed(
        dealt,
        answers,
        train_docs,
        train_docs + (known[1] or 0),
        known[0] + int(train_docs > 0),
    )


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the id, as text, falls into this fold by its checksum."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold
