"""Pack documents into fixed windows by multiway differencing.

A document is its token ids and an end id. What fills a whole window becomes one; the
rest is cut into short pieces, and a pool of pieces is spread over windows of nearly equal
length by the multiway form of the Karmarkar-Karp method: of all partial partitions, the
two of widest spread are merged with opposing order, largest window on smallest, until one
is left. Where a window comes out above capacity, the number of windows rises by one.

Everything happens in the task that reads the documents: nothing is shuffled, and a task
holds one pool. A window's id has the partition's number in its upper half.

Null text is empty (its document is the end id alone); a null id stays null; equal rows
are documents of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stormledger.llm.tokens import Encoder

CAPACITY = 2048
PIECE = 512
POOL = 1024
END_ID = 1


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Spread items over windows of nearly equal sums; the items of each window."""
    left: list[int] = [-1] * len(sizes)
    right: list[int] = [-1] * len(sizes)
    heap = []
    for item, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        nodes = np.full(windows, -1, np.int64)
        sums[0], nodes[0] = size, item
        heap.append((-size if windows > 1 else 0, item, sums, nodes))
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        _, _, a, a_nodes = heapq.heappop(heap)
        _, _, b, b_nodes = heapq.heappop(heap)
        b, b_nodes = b[::-1], b_nodes[::-1]
        sums, nodes = a + b, np.where(a_nodes < 0, b_nodes, a_nodes)
        both = np.flatnonzero((a_nodes >= 0) & (b_nodes >= 0))
        nodes[both] = len(left) + np.arange(len(both))
        left.extend(a_nodes[both].tolist())
        right.extend(b_nodes[both].tolist())
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), made, sums, nodes))
        made += 1
    found = []
    for top in heap[0][3].tolist() if heap else []:
        items, open_nodes = [], [top] if top >= 0 else []
        while open_nodes:
            node = open_nodes.pop()
            if left[node] < 0:
                items.append(node)
            else:
                open_nodes += [right[node], left[node]]
        if items:
            found.append(items)
    return found


def fill(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows for these items, each within capacity, with as few windows as that takes."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = differencing(sizes, windows)
        if all(sum(sizes[i] for i in items) <= capacity for items in found):
            return found
        windows += 1


def cuts(length: int, capacity: int, piece: int) -> Iterator[tuple[int, int]]:
    """(start, length) of each piece: whole windows, then near-equal short pieces."""
    whole = length // capacity * capacity
    for start in range(0, whole, capacity):
        yield start, capacity
    rest = length - whole
    parts = -(-rest // piece)
    for k in range(parts):
        begin, end = rest * k // parts, rest * (k + 1) // parts
        yield whole + begin, end - begin


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    piece: int = PIECE,
    pool: int = POOL,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: where it comes from, and its window and place there."""
    fields = [
        T.StructField("doc_id", docs.schema[id_column].dataType),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        next_window = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        waiting: list[tuple] = []
        kinds = [("doc_id", None)] + [(f.name, pa.int64()) for f in fields[1:7]]

        def row(doc, start, ids, total, window, offset):
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            rows.append((doc, start, len(ids), crc, total, window, offset, ids))

        def settle() -> None:
            nonlocal next_window
            for items in fill([len(w[2]) for w in waiting], capacity):
                offset = 0
                for i in items:
                    row(*waiting[i], next_window, offset)
                    offset += len(waiting[i][2])
                next_window += 1
            waiting.clear()

        def out(doc_kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*rows))
            arrays = [
                pa.array(columns[k], doc_kind if kind is None else kind)
                for k, (_, kind) in enumerate(kinds)
            ]
            names = [name for name, _ in kinds]
            if with_ids:
                arrays.append(pa.array(columns[7], pa.list_(pa.int32())))
                names.append("ids")
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        doc_kind = None
        for batch in batches:
            doc_kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encoder.encode(text.as_py() or ""), END_ID)
                for start, length in cuts(len(ids), capacity, piece):
                    part = (doc, start, ids[start : start + length], len(ids))
                    if length == capacity:
                        row(*part, next_window, 0)
                        next_window += 1
                    else:
                        waiting.append(part)
                        if len(waiting) >= pool:
                            settle()
                if len(rows) >= 4 * pool:
                    yield out(doc_kind)
        settle()
        if rows:
            yield out(doc_kind)

    return docs.select(id_column, text_column).mapInArrow(packed, T.StructType(fields))
