"""Chat formatting at the level of tokens.

Role and text of each turn are encoded by themselves, as ordinary text, and reserved ids
above the vocabulary are spliced in between: TURN role TEXT text END. So no text can make a
control token. In the rendered string the marks are written out, and a control string that
occurs in a text is escaped by a backslash after its first character (backslashes are
doubled), which reading back undoes.

Encoding is done turn by turn wherever the rows lie. Then rows meet by conversation, sorted
by turn, and prefix sums over the lengths give each turn's place in its conversation and
the span under the loss mask (the texts of the assistant). The assembly streams: a task
holds one batch, however many turns a conversation has. A conversation is a sequence, so its
turns are read by one task.

Null text and null role are empty. Equal turn numbers follow by role, then text. Rows with
null conversation id are one conversation. An empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormledger.llm.tokens import Encoder

TURN, TEXT, END = 50257, 50258, 50259
MARKS = {TURN: "<|turn|>", TEXT: "<|text|>", END: "<|end|>"}
#: Control strings of common templates, escaped inside texts.
CONTROLS = [*MARKS.values(), "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]"]
LOSS_ROLE = "assistant"
_ESCAPE = re.compile("|".join(map(re.escape, ["\\", *CONTROLS])))
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    r"""Drop each backslash and keep what follows: ``\\`` is a backslash again."""
    return _UNESCAPE.sub(r"\1", text)


def render(ids: list[int], encoder: Encoder) -> str:
    """The string that these ids stand for, marks written out."""
    out, begin = [], 0
    for at, i in enumerate([*ids, TURN]):
        if i in MARKS:
            out.append(encoder.decode(ids[begin:at]))
            if at < len(ids):
                out.append(MARKS[i])
            begin = at + 1
    return "".join(out)


def encode_turns(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """(conv_id, turn, role, text, ids, text_at): each turn's ids and where its text begins."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            ids, text_at = [], []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                head = [TURN, *encoder.encode_plain(escape(role or "")), TEXT]
                ids.append([*head, *encoder.encode_plain(escape(text or "")), END])
                text_at.append(len(head))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(text_at, pa.int32())],
                ["conv_id", "turn", "role", "text", "ids", "text_at"],
            )

    rows = conversations.select("conv_id", "turn", "role", "text")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(encoded, f"{kinds}, ids array<int>, text_at int")


def assemble(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """(conv_id, turn, ids, start, loss_start, loss_end), in order within each partition.

    A conversation's ids are those of its turns one after the other; ``start`` is a turn's
    place among them, and ``loss_start`` to ``loss_end`` what the loss covers, null for none.
    """

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, at, begun = None, 0, False
        for batch in batches:
            starts, low, high = [], [], []
            convs, roles = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            lengths = batch.column(3).value_lengths().to_pylist()
            heads = batch.column(4).to_pylist()
            for c, role, length, head in zip(convs, roles, lengths, heads):
                if not begun or c != conv:
                    conv, at, begun = c, 0, True
                starts.append(at)
                masked = role == LOSS_ROLE
                low.append(at + head if masked else None)
                high.append(at + length - 1 if masked else None)
                at += length
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(3),
                    *(pa.array(x, pa.int64()) for x in (starts, low, high)),
                ],
                ["conv_id", "turn", "ids", "start", "loss_start", "loss_end"],
            )

    turns = encode_turns(conversations, tokenizer)
    ordered = (
        turns.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "turn", "role", "ids", "text_at")
    )
    kinds = {f.name: f.dataType.simpleString() for f in turns.schema}
    return ordered.mapInArrow(
        placed,
        f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, ids array<int>, start bigint, "
        "loss_start bigint, loss_end bigint",
    )


def read_back(assembled: DataFrame, tokenizer: str) -> DataFrame:
    """Per conversation: what its ids and mask say, as digests."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        conv, state = None, None

        def close() -> tuple:
            n, turns, loss_chars, loss, chars = state
            return conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

        def out(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*rows))
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars".split()
            made = [pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(made, names)

        kind = None
        for batch in batches:
            kind, done = batch.schema.field(0).type, []
            rows = zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5)))
            for c, ids, start, low, high in rows:
                if state is None or c != conv:
                    if state is not None:
                        done.append(close())
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                middle = ids.index(TEXT)
                role = unescape(encoder.decode(ids[1:middle]))
                text = unescape(encoder.decode(ids[middle + 1 : -1]))
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if low is not None:
                    learnt = unescape(encoder.decode(ids[low - start : high - start]))
                    state[2] += len(learnt)
                    state[3].update(learnt.encode())
                state[4] += len(render(ids, encoder))
            if done:
                yield out(done, kind)
        if state is not None:
            yield out([close()], kind)

    kind = assembled.schema["conv_id"].dataType.simpleString()
    return assembled.mapInArrow(
        read,
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    )


def with_sample(conversations: DataFrame) -> DataFrame:
    """The table and a conversation -1 that says control strings."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    kinds = {f.name: f.dataType for f in rows.schema}
    said = "</s>[INST] ok [/INST]"
    sample = rows.sparkSession.range(2).select(
        F.lit(-1).cast(kinds["conv_id"]).alias("conv_id"),
        F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return rows.unionByName(sample)
