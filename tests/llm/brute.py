"""Plain Python versions of what the operators compute, over lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import random
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def spaced(text: str | None) -> list[str]:
    return SPACED.findall(text or "")


def letters(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").translate(FOLD))


def corpus(seed: int, n: int = 60, longest: int = 160) -> list[tuple[int, str]]:
    """Documents over few words, with copies, near copies and passages in common."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ka", "Lo", "mé", "su", "ti") for b in ("ra", "ne", "pû", "x1")]
    passage = " ".join(rng.choice(words) for _ in range(70))
    texts: list[str] = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.15:
            texts.append(rng.choice([str, str.upper, str.title])(rng.choice(texts)))
        elif texts and kind < 0.45:
            parts = rng.choice(texts).split(" ")
            for _ in range(rng.randint(1, 3)):
                parts[rng.randrange(len(parts))] = rng.choice(words)
            texts.append(" ".join(parts))
        else:
            parts = [rng.choice(words) for _ in range(rng.randint(0, longest))]
            if rng.random() < 0.3:
                parts[len(parts) // 2 : len(parts) // 2] = passage.split(" ")
            texts.append(rng.choice([" ", "  ", "\n", "\t "]).join(parts))
    ids = rng.sample(range(1000), n)
    return list(zip(ids, texts))


def shingles(text: str | None, k: int, fold: bool = True) -> frozenset:
    words = spaced((text or "").translate(FOLD) if fold else text)
    if not words:
        return frozenset()
    if len(words) < k:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def jaccard_classes(docs, k: int, num: int, den: int, fold: bool = True) -> dict:
    """id -> (set size, smallest id of the class); ids are distinct here."""
    sets = [(d, shingles(t, k, fold)) for d, t in docs]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            both = len(s & t)
            if s and t and den * both >= num * (len(s) + len(t) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (len(s), find(d)) for d, s in sets}


def substring_dedup(docs, k: int) -> dict:
    first: dict = {}
    for d, t in docs:
        words = spaced(t)
        for i in range(len(words) - k + 1):
            g = tuple(words[i : i + k])
            first[g] = min(first.get(g, d), d)
    out = {}
    for d, t in docs:
        words, gone = spaced(t), set()
        for i in range(len(words) - k + 1):
            if first[tuple(words[i : i + k])] < d:
                gone |= set(range(i, i + k))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[d] = (len(words), len(gone), kept)
    return out


def contamination(docs, items) -> dict:
    windows: dict = {}
    for item, text in items:
        words = letters(text)
        m = min(10, len(words))
        for i in range(len(words) - m + 1 if m else 0):
            windows.setdefault(tuple(words[i : i + m]), set()).add(item)
    out = {}
    for d, t in docs:
        words, hit, met = letters(t), set(), set()
        for m in range(1, 11):
            for i in range(len(words) - m + 1):
                found = windows.get(tuple(words[i : i + m]))
                if found:
                    hit |= set(range(i, i + m))
                    met |= found
        ids = sorted(str(x) for x in met if x is not None)
        out[d] = (len(words), len(hit), ids)
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal(text: str | None) -> list[tuple[str, int, int]]:
    rules = (
        ("email", EMAIL, lambda m: True),
        ("ip", IP, lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", CARD, lambda m: 13 <= len(_digits(m)) <= 19 and luhn(_digits(m))),
        ("phone", PHONE, lambda m: 9 <= len(_digits(m)) <= 15),
    )
    return [
        (kind, m.start(), m.end())
        for kind, pattern, good in rules
        for m in pattern.finditer(text or "")
        if good(m[0])
    ]


def quality_counts(text: str | None) -> tuple:
    text = text or ""
    words = spaced(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if spaced(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def phrase_places(text: str | None) -> tuple[int, list[int], list[str]]:
    words, places, labels = letters(text), [], set()
    known = {
        "cc by": "cc-by",
        "general public license": "gpl",
        "all rights reserved": "reserved",
    }
    for phrase, label in known.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), places, sorted(labels)
