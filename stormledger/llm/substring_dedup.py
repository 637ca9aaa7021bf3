"""Exact removal of passages that an earlier document has.

Every window of fifty words has a Rabin-Karp hash. Spark brings the hashes of all blocks of
documents together by value and counts the blocks that hold each; a window is removed where
its hash also starts in a document with a smaller id, which is another block before this one
or an earlier document of this block. Overlapping and touching windows merge into maximal
intervals, whose words go.

The hashes have 64 bits; in ten billion windows a few may meet by chance.

Null text is empty. Documents with equal ids do not remove from each other. A null id counts
as larger than any and smaller than none: such a document loses what others have, and
others lose nothing to it. Ids may be numbers, texts (in the order of their bytes), dates or
times. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stormledger.llm import blocks
from stormledger.llm.fingerprints import windows, word_hashes

WINDOW = 50
_NO_ID = np.iinfo(np.int64).max


def _ordered(ids: pa.ChunkedArray) -> np.ndarray:
    """A number for each id of a block, in the order of the ids; null is the largest."""
    if pa.types.is_integer(ids.type):
        return ids.cast(pa.int64()).fill_null(_NO_ID).to_numpy()
    if pa.types.is_string(ids.type):
        ids = ids.cast(pa.binary())  # Spark orders texts by their bytes
    values = ids.to_pylist()
    place = {x: k for k, x in enumerate(sorted({x for x in values if x is not None}))}
    return np.array([_NO_ID if x is None else place[x] for x in values], np.int64)


def _block_windows(table: pa.Table, window: int):
    """Everything about a block's windows, in an order that both groupings share."""
    texts = blocks.encoded(table.column("text"))
    ids = _ordered(table.column("doc_id"))
    hashes, offsets = word_hashes(texts)
    places, values = windows(hashes, offsets, window)
    doc = ids[np.searchsorted(offsets, places, side="right") - 1]
    order = np.lexsort((doc, values))
    ranked = values[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, bool)
    return texts, offsets, places, doc, order, ranked, new


def _covered(n_words: int, places: np.ndarray, window: int) -> np.ndarray:
    steps = np.zeros(n_words + 1, np.int64)
    np.add.at(steps, places, 1)
    np.add.at(steps, places + window, -1)
    return np.cumsum(steps[:-1]) > 0


def _intervals(gone: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, block_bytes: int = blocks.BLOCK_BYTES
) -> DataFrame:
    """(doc_id, n_words, n_removed, removed intervals of words, kept words joined by spaces)."""
    spread, id_blocks, bins = blocks.dealt(docs.select("doc_id", "text"), block_bytes)

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        *_, ranked, new = _block_windows(table, window)
        return blocks.asked(key[0].as_py(), ranked[new], bins, np.uint64)

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        def elsewhere(group: np.ndarray, block: np.ndarray) -> np.ndarray:
            first = block[np.searchsorted(group, group)]  # the smallest block with this hash
            return (first < block) & (first < id_blocks)

        return blocks.answered(table, np.uint64, elsewhere)

    def remove(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        texts, offsets, places, doc, order, ranked, new = _block_windows(table, window)
        before = np.zeros(0, bool)
        if len(ranked):
            at = np.cumsum(new) - 1
            smallest = doc[order][np.flatnonzero(new)][at]
            before = blocks.joined_answers(answers)[at].astype(bool) | (doc[order] > smallest)
        gone = _covered(int(offsets[-1]), places[order][before], window)
        kept, removed, n_words, n_removed = [], [], [], []
        for k, text in enumerate(texts):
            own = gone[offsets[k] : offsets[k + 1]]
            words = text.split()
            n_words.append(len(words))
            n_removed.append(int(own.sum()))
            removed.append(_intervals(own) if n_removed[-1] else [])
            if n_removed[-1]:
                words = [words[i] for i in np.flatnonzero(~own)]
            kept.append(b" ".join(words))
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "removed": pa.array(
                    removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                ),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    asked = spread.groupBy("block").applyInArrow(ask, blocks.ASK)
    answers = asked.groupBy("bin").applyInArrow(answer, blocks.ANSWER)
    return (
        spread.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            remove,
            f"doc_id {kind}, n_words bigint, n_removed bigint, "
            "removed array<struct<start: bigint, end: bigint>>, kept string",
        )
    )
