"""Phrase collocations, from n-grams that are frequent for certain.

Pass one finds all n-grams (one to four words) that may be frequent. A task hashes its n-grams and
sends each distinct one once, with its count, to the hash partition that its hash falls into. A
hash partition keeps a Misra-Gries summary: the parts from all tasks are merged one after the
other, and whenever more counters are left than the capacity, the largest count beyond it is
taken off all of them. The capacity is ``ROOM`` times the partition's mass (its number of
occurrences) divided by the threshold, so no count loses more than a ``ROOM``-th of the
threshold, and whatever occurs often enough survives. Equal hashes of different n-grams only add
to the counts, so they let more through and hold nothing back. There are as many partitions as
the texts have stretches of ``PART_BYTES``, so a partition has one size however large the corpus.

Pass two counts the survivors exactly, by their words. The survivors reach the tasks as a bitmap of
a fixed size; what it lets through by chance is counted as well, and is infrequent. Scores,
containment and ranks are joins and windows over the frequent n-grams.

Everything is per language; a null language is ``und``. Null texts are empty. Texts are handled in
stretches of a megabyte, cut between words, with the last words carried over, so very long ones
need no more memory. Repeated rows count as often as they stand there. Equal scores rank by
count, then by the phrase's UTF-8 bytes. Empty tables give no rows. Ids and further columns are
not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormledger.llm import fingerprints
from stormledger.llm.counters import Run, added, tallied
from stormledger.llm.fingerprints import mix, pack_planes, unpack_planes
from stormledger.storage import durable

THRESHOLD = 30
LONGEST = 4
TOP = 2000
SCALE = 2_000_000
CONTAINED_PERCENT = 80
ROOM = 8
PART_BYTES = 8 << 20
STRETCH_BYTES = 1 << 20
HELD = 1 << 21  # counters that a task holds before it sends them
FLUSHED = 400_000  # phrases that a task counts before it sends them
KEY_BITS = 48  # of a hash, in pass one
BITMAP_BITS = 27
BUCKET_BITS = 15  # of Spark's bitmaps
_BREAKS = b".,;:!?\n\x0b\x0c\r"
#: A-Z to lower case, tabs to spaces.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if b == 0x09 else b for b in range(256))
_GAPS = re.compile(rb"  +")
_GAP = re.compile(rb"[ .,;:!?\x0a-\x0d]")
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[list(_BREAKS)] = True
_IS_GAP = _IS_BREAK.copy()
_IS_GAP[0x20] = True


class Stretch:
    """The words of some bytes: where they start and end, their hashes, the pieces they lie in."""

    def __init__(self, data: bytes, carried: int):
        self.data, self.carried = data, carried
        codes = np.frombuffer(data, np.uint8)
        gap = _IS_GAP[codes]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
        self.starts, self.ends = edge[::2], edge[1::2]
        sums = fingerprints._sums(fingerprints._BYTE[codes], fingerprints._BYTE_BASE)
        inverse = fingerprints._upto(fingerprints._BYTE_BASE, len(codes))[1]
        raw = (sums[self.ends] - sums[self.starts]) * inverse[self.starts]
        self.hashes = mix(raw + (self.ends - self.starts).astype(np.uint64))
        piece = np.cumsum(_IS_BREAK[codes])[self.starts]
        self.offsets = np.concatenate(
            ([0], np.flatnonzero(np.diff(piece)) + 1, [len(self.starts)])
        )

    def grams(self, n: int, salt: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of the n-grams that the stretch before did not have."""
        places, hashes = fingerprints.windows(self.hashes, self.offsets, n)
        new = places + n > self.carried
        return places[new], mix(hashes[new] + salt)


def stretches(text: bytes) -> Iterator[Stretch]:
    """A text (already folded) in stretches that share their last and first words."""
    at = done = carried = 0
    while done < len(text):
        cut = _GAP.search(text, done + STRETCH_BYTES)
        end = cut.start() if cut else len(text)
        stretch = Stretch(text[at:end], carried)
        yield stretch
        carried = min(LONGEST - 1, len(stretch.starts))
        at, done = (at + int(stretch.starts[-carried]) if carried else end), end


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """(language, all its texts as one, a break between them)."""
    texts: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        texts.setdefault(lang, []).append((text or "").encode().translate(_FOLD))
    for lang, parts in texts.items():
        yield lang, _GAPS.sub(b" ", b"\n".join(parts))


def _salt(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "big"))


def _keys(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - KEY_BITS)


class Summary:
    """A Misra-Gries summary of at most ``capacity`` counters; summaries merge by adding."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.lost = 0  # what any count may fall short by

    def merge(self, runs: list[Run]) -> None:
        self.keys, self.counts = added([(self.keys, self.counts), *runs])
        beyond = len(self.keys) - self.capacity
        if beyond > 0:
            cut = int(np.partition(self.counts, beyond - 1)[beyond - 1])
            self.lost += cut
            left = self.counts > cut
            self.keys, self.counts = self.keys[left], self.counts[left] - cut

    def survivors(self, threshold: int) -> np.ndarray:
        return self.keys[self.counts + self.lost >= threshold]


def partial_counts(docs: DataFrame, parts: int) -> DataFrame:
    """(part, mass, cell): every task's distinct n-grams by hash partition, keys and counts packed."""
    schema = pa.schema({"part": pa.int32(), "mass": pa.int64(), "cell": pa.binary()})
    edges = np.array([-(-(i << KEY_BITS) // parts) for i in range(parts + 1)], np.uint64)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[Run] = []

        def sent() -> Iterator[pa.RecordBatch]:
            keys, counts = added(runs)
            runs.clear()
            at = np.searchsorted(keys, edges)
            for part in np.flatnonzero(np.diff(at)):
                k, c = keys[at[part] : at[part + 1]], counts[at[part] : at[part + 1]]
                cell = pack_planes(k) + pack_planes(c)
                row = {"part": int(part), "mass": int(c.sum()), "cell": cell}
                yield pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for lang, text in _by_language(batch):
                salt = _salt(lang)
                for stretch in stretches(text):
                    for n in range(1, LONGEST + 1):
                        keys = _keys(stretch.grams(n, salt)[1])
                        if len(keys):
                            runs.append(tallied(keys))
                    if sum(len(k) for k, _ in runs) >= HELD:
                        yield from sent()
        if runs:
            yield from sent()

    return docs.mapInArrow(counted, "part int, mass bigint, cell binary")


def may_be_frequent(cells: DataFrame, threshold: int) -> DataFrame:
    """(key): what the hash partitions' summaries still hold, and may occur often enough."""

    def merged(table: pa.Table) -> pa.Table:
        mass = sum(table.column("mass").to_pylist())
        summary = Summary(ROOM * (mass // threshold) + 1)
        runs, held = [], 0
        for chunk in table.column("cell").chunks:
            for cell in chunk:
                data = cell.as_buffer()
                half = data.size // 2
                runs.append(
                    (unpack_planes(data[:half], np.uint64), unpack_planes(data[half:], np.int64))
                )
                held += len(runs[-1][0])
                if held > summary.capacity:
                    summary.merge(runs)
                    runs, held = [], 0
        if runs:
            summary.merge(runs)
        keys = summary.survivors(threshold).astype(np.int64)
        return pa.table({"key": pa.array(keys, pa.int64())})

    return cells.groupBy("part").applyInArrow(merged, "key bigint")


def bitmap(keys: DataFrame) -> np.ndarray:
    """One bit for each of the keys' low bits, as bytes of a fixed number."""
    low = F.col("key").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    rows = (
        keys.groupBy(F.shiftright(low, BUCKET_BITS).alias("bucket"))
        .agg(F.bitmap_construct_agg(low.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1))).alias("bits"))
        .collect()
    )
    out = np.zeros((1 << BITMAP_BITS - BUCKET_BITS, 1 << BUCKET_BITS - 3), np.uint8)
    for bucket, bits in rows:
        out[bucket] = np.frombuffer(bits, np.uint8)
    return out.reshape(-1)


def exact_counts(docs: DataFrame, known: np.ndarray, threshold: int, parts: int) -> DataFrame:
    """(lang, words, phrase, n): the frequent n-grams, and per language, with no words, all words.

    A task sends its counts as lists, one for each hash partition, language and number of words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        found: dict[tuple[str, int], Counter] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for (lang, n), counts in found.items():
                dealt: dict[int, list[bytes]] = {}
                for phrase in counts:
                    dealt.setdefault(crc32(phrase) % parts, []).append(phrase)
                rows = len(dealt)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(dealt, pa.int32()),
                        pa.array([lang] * rows, pa.string()),
                        pa.array([n] * rows, pa.int32()),
                        pa.array(list(dealt.values()), pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                        pa.array([[counts[p] for p in x] for x in dealt.values()], pa.list_(pa.int64())),
                    ],
                    ["part", "lang", "words", "phrases", "counts"],
                )
            found.clear()

        for batch in batches:
            for lang, text in _by_language(batch):
                salt = _salt(lang)
                for stretch in stretches(text):
                    starts, ends, data = stretch.starts, stretch.ends, stretch.data
                    for n in range(1, LONGEST + 1):
                        places, hashes = stretch.grams(n, salt)
                        if n == 1:
                            found.setdefault((lang, 0), Counter())[b""] += len(places)
                        at = _keys(hashes) & np.uint64((1 << BITMAP_BITS) - 1)
                        hit = bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1
                        places = places[hit.astype(bool)]
                        spans = zip(starts[places].tolist(), ends[places + n - 1].tolist())
                        found.setdefault((lang, n), Counter()).update(data[a:b] for a, b in spans)
                    if sum(map(len, found.values())) >= FLUSHED:
                        yield from sent()
        yield from sent()

    def summed(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lists = table.column("phrases").combine_chunks()
        row = pc.list_parent_indices(lists)
        one = pa.table(
            {
                "lang": table.column("lang").take(row),
                "words": table.column("words").take(row),
                "phrase": lists.flatten(),
                "n": table.column("counts").combine_chunks().flatten(),
            }
        )
        all_of = one.group_by(["lang", "words", "phrase"]).aggregate([("n", "sum")])
        all_of = all_of.select(["lang", "words", "phrase", "n_sum"]).rename_columns(one.column_names)
        often = pc.or_(pc.equal(all_of["words"], 0), pc.greater_equal(all_of["n"], threshold))
        return all_of.filter(often)

    cells = docs.mapInArrow(
        counted, "part int, lang string, words int, phrases array<string>, counts array<bigint>"
    )
    return cells.groupBy("part").applyInArrow(summed, "lang string, words int, phrase string, n bigint")


def frequent(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(lang, words, phrase, n) of all n-grams that occur so often, written to the shared folder."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // PART_BYTES
    known = bitmap(may_be_frequent(partial_counts(rows, parts), threshold))
    return durable(exact_counts(rows, known, threshold, parts))


def _run_of(words: Column, first: Column | int, number: Column) -> Column:
    return F.array_join(F.slice(words, first, number), " ")


def scored(grams: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score): every phrase at its lowest-scoring cut."""
    parts = F.split("phrase", " ")
    cuts = (
        grams.where("words >= 2")
        .select(
            *("lang", "phrase", "words", F.col("n").alias("a")),
            F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"),
        )
        .select(
            "*",
            _run_of(parts, 1, F.col("k")).alias("head"),
            _run_of(parts, F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"),
        )
    )
    known = grams.where(F.col("words").between(1, LONGEST - 1))
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    # exact at any size: the quotient of decimals, cut to a whole number
    score = F.expr(
        f"(CAST(a AS DECIMAL(19, 0)) * {SCALE}) DIV (CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0)))"
    )
    return (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .groupBy("lang", "phrase", "words", "a")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")
    )


def contained(grams: DataFrame, percent: int = CONTAINED_PERCENT) -> DataFrame:
    """(lang, phrase): phrases that a longer one of nearly their count contains."""
    parts = F.split("phrase", " ")
    sizes = F.sequence(F.lit(2), F.col("words") - 1)
    inside = (
        grams.where("words >= 3")
        .select("lang", "phrase", "words", "n", F.explode(sizes).alias("size"))
        .select("*", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at"))
        .select(
            "lang", _run_of(parts, F.col("at"), F.col("size")).alias("phrase"), F.col("n").alias("longer")
        )
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    own = grams.where("words >= 2").select("lang", "phrase", "n")
    most = F.col("longer").cast("decimal(19,0)") * 100 >= F.col("n").cast("decimal(19,0)") * percent
    return own.join(inside, ["lang", "phrase"]).where(most).select("lang", "phrase")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases."""
    grams = frequent(docs, threshold)
    best = scored(grams).join(contained(grams), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = grams.where("words = 0").select("lang", "n")
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
