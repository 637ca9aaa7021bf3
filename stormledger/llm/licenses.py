"""License notices by template markup.

A template is wording with two kinds of regions: ``[[ ... ]]`` may be absent, and
``{{ low-high }}`` stands for so many words of any kind. Each is compiled into an automaton
over words. A text is accepted where the mandatory wording matches exactly, word by word,
with optional regions present or absent and replaceable ones within their bounds. Case of
A-Z and punctuation do not count.

Each text is taken as a whole, in the task that reads it. An automaton starts only where a
first word of its template stands, and only in texts that hold its longest mandatory run.

Null and empty texts have no words and no labels; null ids are carried; equal rows get equal
results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The base phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Notices of common licenses.
TEMPLATES = {
    "apache-2.0": ["licensed under the [[terms of the]] apache license version 2 0"],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met"
    ],
    "cc-by-4.0": ["licensed under [[a]] [[creative commons]] cc by 4 0 [[international]]"],
    "cc-by-nc-4.0": ["licensed under [[a]] [[creative commons]] cc by nc 4 0 [[international]]"],
    "cc-by-sa-4.0": ["licensed under [[a]] [[creative commons]] cc by sa 4 0 [[international]]"],
    "copyright": ["copyright [[c]] {{1-8}} all rights reserved"],
    "gpl-2.0": [
        "{{1-3}} licensed under the [[terms of the]] gnu general public license "
        "[[as published by the free software foundation]] [[either]] version 2"
    ],
    "gpl-3.0": [
        "{{1-3}} licensed under the [[terms of the]] gnu general public license "
        "[[as published by the free software foundation]] [[either]] version 3"
    ],
    "mit": [
        "released under the [[terms of the]] mit license",
        "licensed under the [[terms of the]] mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction",
    ],
}

#: Bytes to what they count as: A-Z lower-cased, other ASCII but digits and a-z a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
_MARK = re.compile(r"\[\[|\]\]|\{\{\d+-\d+\}\}|[^\s\[\]{}]+")


@dataclass
class Automaton:
    """States with edges on a word, or on any word (None); ``skips`` need no word."""

    label: str
    edges: list[list[tuple[bytes | None, int]]] = field(default_factory=list)
    skips: list[list[int]] = field(default_factory=list)
    anchor: bytes = b""
    first: frozenset = frozenset()
    final: int = 0

    def state(self) -> int:
        self.edges.append([])
        self.skips.append([])
        return len(self.edges) - 1

    def closure(self, states) -> frozenset:
        seen, open_states = set(states), list(states)
        while open_states:
            for s in self.skips[open_states.pop()]:
                if s not in seen:
                    seen.add(s)
                    open_states.append(s)
        return frozenset(seen)

    def longest(self, words: list[bytes], at: int) -> int:
        """End of the longest match that begins at this word; -1 without any."""
        states, end = self.closure([0]), -1
        for place in range(at, len(words) + 1):
            if self.final in states:
                end = place
            if place == len(words):
                break
            word = words[place]
            states = self.closure(
                [to for s in states for on, to in self.edges[s] if on is None or on == word]
            )
            if not states:
                break
        return end


def compile_template(label: str, template: str) -> Automaton:
    made = Automaton(label)
    here, opened, runs, run = made.state(), [], [], []
    for mark in _MARK.findall(template):
        if mark in ("[[", "]]") or mark[0] == "{":
            runs.append(run)
            run = []
        if mark == "[[":
            opened.append(here)
        elif mark == "]]":
            made.skips[opened.pop()].append(here)
        elif mark[0] == "{":
            low, high = map(int, mark.strip("{}").split("-"))
            passed = [here]
            for _ in range(high):
                passed.append(made.state())
                made.edges[passed[-2]].append((None, passed[-1]))
            for state in passed[low:-1]:
                made.skips[state].append(passed[-1])
            here = passed[-1]
        else:
            word, after = mark.encode(), made.state()
            made.edges[here].append((word, after))
            here = after
            if not opened:
                run.append(word)
    made.final = here
    made.anchor = b" " + b" ".join(max([*runs, run], key=len)) + b" "
    made.first = frozenset(on for s in made.closure([0]) for on, _ in made.edges[s])
    return made


def compiled(templates: dict[str, list[str]]) -> list[Automaton]:
    return [compile_template(label, t) for label, texts in templates.items() for t in texts]


def scan_text(text: bytes, phrases: dict[bytes, str], automata: list[Automaton]) -> tuple:
    """(words, places of base phrases, their labels, template matches)."""
    words = text.translate(_FOLD).split()
    joined = b" " + b" ".join(words) + b" "
    places, labels = [], set()
    for phrase, label in phrases.items():
        at = joined.find(phrase)
        if at >= 0:
            labels.add(label)
        place, done = 0, 0
        while at >= 0:  # words between neighbouring hits are counted once
            place += joined.count(b" ", done, at)
            places.append(place)
            done, at = at, joined.find(phrase, at + 1)
    matches = []
    for automaton in automata:
        if automaton.anchor not in joined:
            continue
        anything = None in automaton.first
        for at, word in enumerate(words):
            if anything or word in automaton.first:
                end = automaton.longest(words, at)
                if end >= 0:
                    matches.append((automaton.label, at, end))
    return len(words), places, labels, matches


def scan(
    docs: DataFrame,
    templates: dict[str, list[str]] = TEMPLATES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: counts and places of the base phrases, labels, score, matches.

    The score is 1 where a template accepts, 0.5 where only base phrases stand, else 0.
    """

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = compiled(templates)
        phrases = {b" " + p.encode() + b" ": label for p, label in PHRASES.items()}
        for batch in batches:
            rows = []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                n, places, labels, matches = scan_text(text or b"", phrases, automata)
                every = sorted(labels | {m[0] for m in matches})
                rows.append(
                    {
                        "n_words": n,
                        "n_base": len(places),
                        "first_word": min(places, default=None),
                        "last_word": max(places, default=None),
                        "base_labels": sorted(labels),
                        "labels": every,
                        "score": 1.0 if matches else 0.5 if labels else 0.0,
                        "matches": [dict(zip(("label", "start", "end"), m)) for m in matches],
                    }
                )
            span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
            kinds = {
                "n_words": pa.int64(),
                "n_base": pa.int64(),
                "first_word": pa.int64(),
                "last_word": pa.int64(),
                "base_labels": pa.list_(pa.string()),
                "labels": pa.list_(pa.string()),
                "score": pa.float64(),
                "matches": pa.list_(span),
            }
            made = [pa.array([r[k] for r in rows], kind) for k, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["doc_id", *kinds])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column)).mapInArrow(
        scanned,
        f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels array<string>, labels array<string>, score double, "
        "matches array<struct<label: string, start: bigint, end: bigint>>",
    )
