"""Set similarity join of word n-gram sets with set-relation skipping.

Documents are sets of hashes of n-grams of words, with A-Z in lower case. Two sets link when their Jaccard similarity reaches a
fraction. The result is each document's class: everything reachable by links.

1. Equal sets are one set from here on (its signature: a 64-bit sum of its members).
2. All n-grams are ordered, rarest first, by document counts over the whole corpus. A set of
   size n can only reach similarity t with a set that shares one of its first
   n - ceil(t n) + 1 n-grams (its prefix). N-grams that only one document has lead nowhere.
3. Each set goes to the longest index list of its prefix, its home. Sets that are alike mostly
   have one home and are compared there with each other, exactly. The answers hold for all
   that they link: a list whose sets all have one class by then, or one home, is skipped as
   a whole. Sets in the other lists get ``MORE_HOMES`` further homes, the longest of these
   lists, and meet there too. From then on, pairs within a class or a home are skipped.
4. The remaining lists are cut into blocks by position. What stands before a shared n-gram in
   the order is not shared, so two blocks whose positions add up to more than a link allows
   are skipped, and in the others each pair has to pass the bounds on size and position.
5. Sets in the pairs that are left meet once more, each once for its cluster of such pairs,
   and are compared exactly. All links together make the classes (large and small stars).

What meets in a task is bounded. A home beyond ``HOME_BYTES`` is cut into parts, and every two
parts meet in a task of their own; clusters of more than ``MEET`` sets are compared pair by
pair. So every pair that may link is compared, however large its group.

Null and empty texts have no set, and a class of their own. Texts shorter than n words are one
n-gram as a whole. Null ids are carried; a class is named by its smallest id that is not
null. Repeated rows are in one class. An empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormledger.llm import blocks
from stormledger.llm.common import whole_row
from stormledger.llm.components import roots
from stormledger.llm.fingerprints import mix, windows, word_hashes
from stormledger.storage import durable

MEET = 1024
HOME_BYTES = 12_000_000
MORE_HOMES = 4
BLOCKS = 4


def _sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash), sorted and distinct: the set of every text, A-Z lower-cased."""
    hashes, offsets = word_hashes([t.lower() for t in texts])  # of bytes: ASCII alone
    places, values = windows(hashes, offsets, words)
    owner = np.searchsorted(offsets, places, side="right") - 1
    sizes = np.diff(offsets)
    owners, all_values = [owner], [values]
    for length in range(1, words):
        short = np.flatnonzero(sizes == length)
        if len(short):
            whole = np.zeros(len(short), np.uint64)
            for k in range(length):
                whole = mix(whole + hashes[offsets[short] + k] + np.uint64(k + length * 1000))
            owners.append(short)
            all_values.append(whole)
    owner, value = np.concatenate(owners), np.concatenate(all_values)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[new], value[new]


def _block_counts(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of a block, sorted; each entry's place there; capped counts."""
    distinct, inverse, counts = np.unique(value, return_inverse=True, return_counts=True)
    return distinct, inverse, np.minimum(counts, 255).astype(np.uint8)


def _rarity(counts: np.ndarray) -> np.ndarray:
    """A byte that grows with the count: exact below 16, then eight steps per doubling."""
    steps = 16 + np.floor(8 * (np.log2(np.maximum(counts, 1)) - 4))
    return np.where(counts < 16, counts, np.minimum(steps, 255)).astype(np.uint8)


def least_overlap(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Members that a set of size n shares at least with any set it links to."""
    return -(-n * num // den)


def prefixes(docs: DataFrame, words: int, num: int, den: int, block_bytes: int) -> DataFrame:
    """(doc_id, text_key, n, sig, tokens, places, members): each document's set.

    ``tokens`` are the prefix n-grams that other documents have too, with their ``places``
    in the order; ``members`` holds the set itself where there are such tokens. Within a
    block only one document of equal sets has them.
    """
    spread, _, bins = blocks.dealt(docs, block_bytes, (F.xxhash64("text").alias("text_key"),))

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        _, value = _sets(blocks.encoded(table.column("text")), words)
        distinct, _, counts = _block_counts(value)
        return blocks.asked(key[0].as_py(), distinct, bins, np.uint32, counts)

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        def rarity(group: np.ndarray, counts: np.ndarray) -> np.ndarray:
            return _rarity(np.bincount(group, counts))[group]

        return blocks.answered(table, np.uint32, rarity, counted=True)

    def choose(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        size = table.num_rows
        owner, value = _sets(blocks.encoded(table.column("text")), words)
        n = np.bincount(owner, minlength=size)
        sums = np.zeros(size, np.uint64)
        np.add.at(sums, owner, mix(value))
        sig = mix(sums + n.astype(np.uint64)).view(np.int64)
        sig[n == 0] = 0
        _, inverse, _ = _block_counts(value)
        rare = blocks.joined_answers(answers)[inverse] if len(value) else np.zeros(0, np.uint8)
        order = np.lexsort((value, rare, owner))
        begin = np.concatenate(([0], np.cumsum(n)))
        place = np.arange(len(value)) - begin[owner]  # the order keeps owners together
        first = np.zeros(size, bool)
        first[np.unique(sig, return_index=True)[1]] = True
        allowed = n - least_overlap(n, num, den) + 1
        use = (place < allowed[owner]) & (rare[order] > 1) & first[owner]
        used = np.bincount(owner[use], minlength=size)
        ends = np.cumsum(used)
        offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
        signed = value.view(np.int64)
        members = [
            value[begin[k] : begin[k + 1]].tobytes() if used[k] else None for k in range(size)
        ]
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "text_key": table.column("text_key"),
                "n": pa.array(n, pa.int64()),
                "sig": pa.array(sig, pa.int64()),
                "tokens": pa.ListArray.from_arrays(offsets, pa.array(signed[order][use])),
                "places": pa.ListArray.from_arrays(
                    offsets, pa.array(place[use].astype(np.int32))
                ),
                "members": pa.array(members, pa.binary()),
            }
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    asks = spread.groupBy("block").applyInArrow(ask, blocks.ASK)
    answers = asks.groupBy("bin").applyInArrow(answer, blocks.ANSWER)
    return (
        spread.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            choose,
            f"doc_id {kind}, text_key bigint, n bigint, sig bigint, tokens array<bigint>, "
            "places array<int>, members binary",
        )
    )


def linked(members: list[bytes], num: int, den: int, old: np.ndarray | None = None) -> np.ndarray:
    """Class number of each set after comparing all pairs whose old classes differ.

    Sets are taken in order of size. One pass over the index of the sets so far counts a
    set's overlap with all of them; those of fitting size decide.
    """
    sets = [np.frombuffer(m, np.uint64) for m in members]
    n = np.array([len(s) for s in sets])
    order = np.argsort(n, kind="stable")
    owner = np.repeat(np.arange(len(order)), n[order])
    value = np.concatenate([sets[i] for i in order])
    _, token = np.unique(value, return_inverse=True)
    by_token = np.argsort(token, kind="stable")
    lists = owner[by_token]
    starts = np.concatenate(([0], np.cumsum(np.bincount(token))))
    begin = np.concatenate(([0], np.cumsum(n[order])))
    parent = np.arange(len(order))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    if old is not None:
        seen: dict[int, int] = {}
        for k, c in enumerate(old[order].tolist()):
            parent[k] = seen.setdefault(c, k)
    sizes = n[order]
    for x in range(1, len(order)):
        low = np.searchsorted(sizes, least_overlap(sizes[x], num, den))
        if low >= x:
            continue
        mine = token[begin[x] : begin[x + 1]]
        spans = [lists[starts[t] : starts[t + 1]] for t in mine if starts[t + 1] > starts[t] + 1]
        if not spans:
            continue
        near = np.concatenate(spans)
        overlap = np.bincount(near[(near >= low) & (near < x)] - low, minlength=x - low)
        union = sizes[x] + sizes[low:x] - overlap
        for y in (np.flatnonzero(den * overlap >= num * union) + low).tolist():
            a, b = find(x), find(y)
            if a != b:
                parent[max(a, b)] = min(a, b)
    result = np.empty(len(order), np.int64)
    result[order] = [find(x) for x in range(len(order))]
    return result


def _candidates(lists: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of sets of different classes and homes that a list may link.

    A row of ``lists`` is a set at its place in a list: (token, sig, homes, label, place, n).
    """
    block = F.floor(F.col("place") * (BLOCKS * num) / (F.col("n") * (den - num))).cast("int")
    rows = lists.withColumn("own", block)
    others = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS) - F.col("own")))
    fit = rows.where(F.col("own") <= BLOCKS).withColumn("other", others)
    left = fit.select("token", "own", "other", "sig", "homes", "label", "place", "n")
    right = fit.select(
        F.col("token").alias("token2"),
        F.col("other").alias("own2"),
        F.col("own").alias("other2"),
        *[F.col(c).alias(f"{c}2") for c in ("sig", "homes", "label", "place", "n")],
    )
    most = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))
    may = (
        (F.col("token") == F.col("token2"))
        & (F.col("own") == F.col("own2"))
        & (F.col("other") == F.col("other2"))
        & (F.col("sig") < F.col("sig2"))
        & (F.col("label") != F.col("label2"))
        & ~F.arrays_overlap("homes", "homes2")
        & (most * den >= (F.col("n") + F.col("n2") - most) * num)
    )
    return left.join(right, may).select(F.col("sig").alias("a"), F.col("sig2").alias("b")).distinct()


def _meetings(pairs: DataFrame) -> DataFrame:
    """(meeting, sig): who meets whom so that both sets of every pair meet.

    A cluster of pairs is a meeting if it is small; else each set meets its partners, so
    many at a time.
    """
    cluster = durable(roots(pairs))
    size = cluster.groupBy("root").agg(F.count("*").alias("sets"))
    known = pairs.join(cluster.withColumnRenamed("node", "a"), "a").join(size, "root")
    partners = F.count("*").over(Window.partitionBy("a"))
    parts = F.ceil(partners / F.lit(MEET)).cast("int")
    apart = F.xxhash64("a", F.pmod(F.xxhash64("b"), parts))
    large = known.where(F.col("sets") > MEET).select(apart.alias("meeting"), "a", "b")
    small = size.where(F.col("sets") <= MEET).join(cluster, "root")
    small = small.select(F.xxhash64("root").alias("meeting"), F.col("node").alias("sig"))
    return (
        small.union(large.select("meeting", F.col("a").alias("sig")))
        .union(large.select("meeting", F.col("b").alias("sig")))
        .distinct()
    )


def _cells(homes: DataFrame) -> DataFrame:
    """Deal the sets (sig, home, n) of a home over cells in which every two parts meet."""
    parts = F.ceil(F.sum("n") * 8 / F.lit(HOME_BYTES)).cast("int")
    sized = homes.join(homes.groupBy("home").agg(parts.alias("parts")), "home")
    own = F.pmod(F.xxhash64("sig", F.lit("part")), F.col("parts")).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.struct(
            F.least(other, F.col("own")).alias("i"), F.greatest(other, F.col("own")).alias("j")
        ),
    )
    return sized.withColumn("own", own).select("sig", "home", F.explode(cells).alias("cell"))


def classes(
    docs: DataFrame,
    words: int = 5,
    num: int = 4,
    den: int = 5,
    block_bytes: int = blocks.BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, text_key, n, sig, root): documents of one root are reachable by links."""
    sets = durable(prefixes(docs, words, num, den, block_bytes))
    first = sets.where("members IS NOT NULL")
    members = first.select("sig", "members").dropDuplicates(["sig"])
    lists = (
        first.select("sig", "n", F.explode(F.arrays_zip("tokens", "places")).alias("t"))
        .groupBy(F.col("t.tokens").alias("token"), "sig")
        .agg(F.min("t.places").alias("place"), F.min("n").alias("n"))
    )
    shared = lists.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1")
    lists = durable(lists.join(shared, "token"))

    longest = F.max_by("token", F.struct("sets", "token"))
    home = durable(lists.groupBy("sig").agg(longest.alias("home"), F.first("n").alias("n")))

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        sig = table.column("sig").to_numpy()
        group = linked([m.as_py() for m in table.column("members")], num, den)
        least = np.full(len(sig), np.iinfo(np.int64).max)
        np.minimum.at(least, group, sig)
        return pa.table({"a": sig, "b": least[group]})

    def links(homes: DataFrame) -> DataFrame:
        """What the sets (sig, home, n) of each home say about each other, as edges."""
        return durable(
            _cells(homes)
            .join(members, "sig")
            .groupBy("home", "cell")
            .applyInArrow(meet, "a bigint, b bigint")
            .where("a <> b")
            .distinct()
        )

    def classed(homes: DataFrame, edges: DataFrame) -> DataFrame:
        """(sig, homes, label): where each set has been, and its class so far."""
        known = homes.groupBy("sig").agg(F.collect_set("home").alias("homes"))
        return durable(
            known.join(roots(edges), F.col("sig") == F.col("node"), "left").select(
                "sig", "homes", F.coalesce("root", "sig").alias("label")
            )
        )

    def still_open(lists: DataFrame, known: DataFrame) -> DataFrame:
        """The lists whose sets have several classes, and not all the same homes."""
        rows = lists.select("token", "sets", "sig", "place", "n").join(known, "sig")
        mixed = rows.groupBy("token").agg(
            (F.min("label") < F.max("label")).alias("classes"),
            (F.min("homes") < F.max("homes")).alias("apart"),
        )
        return durable(rows.join(mixed.where("classes AND apart").select("token"), "token"))

    found = links(home)
    open_lists = still_open(lists, classed(home, found))
    rank = F.row_number().over(Window.partitionBy("sig").orderBy(F.col("sets").desc(), "token"))
    more = (
        open_lists.where(~F.array_contains("homes", F.col("token")))
        .withColumn("rank", rank)
        .where(F.col("rank") <= MORE_HOMES)
        .select("sig", F.col("token").alias("home"), "n")
    )
    homes = durable(home.select("sig", "home", "n").union(more))
    later = homes.join(home.select("sig", "home"), ["sig", "home"], "left_anti")
    labels = classed(homes, found.union(links(later)))
    pairs = durable(_candidates(still_open(open_lists, labels), num, den))

    def between(key: tuple, table: pa.Table) -> pa.Table:
        label = table.column("label").to_numpy()
        group = linked([m.as_py() for m in table.column("members")], num, den, label)
        least = np.full(len(label), np.iinfo(np.int64).max)
        np.minimum.at(least, group, label)
        pairs = np.unique(np.stack([label, least[group]], axis=1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    edges = (
        _meetings(pairs)
        .join(labels.select("sig", "label"), "sig")
        .join(members, "sig")
        .groupBy("meeting")
        .applyInArrow(between, "a bigint, b bigint")
    )
    top = roots(edges.distinct())
    rooted = (
        labels.select("sig", "label")
        .join(top, F.col("label") == F.col("node"), "left")
        .select("sig", F.coalesce("root", "label").alias("root"))
    )
    return (
        sets.select("doc_id", "text_key", "n", "sig")
        .join(rooted, "sig", "left")
        .withColumn("root", F.when(F.col("n") > 0, F.coalesce("root", "sig")))
    )


def named(found: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), a class named by its smallest id."""
    least = found.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    return found.join(least, "root", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """One document of every class, that of the smallest id, with all columns.

    Texts without words have no class, so each stays.
    """
    found = durable(classes(docs.select("doc_id", "text"), words, num, den))
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key"))
    best = found.where("n > 0").groupBy("root").agg(F.min(rank).alias("r"))
    kept = best.select(
        F.col("r.doc_id").alias("k1"), F.col("r.text_key").alias("k2"), F.lit(False).alias("all")
    )
    empty = found.where("n = 0").select("doc_id", "text_key").distinct()
    kept = kept.union(empty.select("doc_id", "text_key", F.lit(True)))
    rows = docs.select(whole_row(docs).alias("row")).select(
        "row", F.col("row.doc_id").alias("k1"), F.xxhash64("row.text").alias("k2")
    )
    same = rows["k1"].eqNullSafe(kept["k1"]) & (rows["k2"] == kept["k2"])
    met = rows.join(kept, same).select("row", rows["k1"], rows["k2"], "all")
    again = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("k1"))
    return met.withColumn("again", again).where("all OR again = 1").select("row.*")
