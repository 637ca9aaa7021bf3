"""The operators against brute force, and on odd rows and empty tables."""

from __future__ import annotations

import random
import time
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from stormledger.functions.arrays import running
from stormledger.llm import (
    blocks,
    chat,
    decontamination,
    jaccard,
    licenses,
    packing,
    pii,
    quality_model,
    quality_rules,
    substring_dedup,
    token_counts,
)
from stormledger.llm.components import roots
from stormledger.llm.tokens import Encoder
from stormledger.storage import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def exact_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids


# --- tokens and packing -------------------------------------------------------------------


def test_ids_are_those_of_the_json_file():
    texts = [*(t for _, t in brute.corpus(1)), "x <|endoftext|> y", "'s  \n\n a", "é\U0001f600"]
    encoder = Encoder(TOKENIZER)
    assert [encoder.encode(t).tolist() for t in texts] == [exact_ids(t) for t in texts]


@pytest.mark.parametrize("seed", range(5))
def test_differencing_places_every_item_once(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 512) for _ in range(rng.randint(1, 300))]
    windows = packing.fill(sizes, 2048)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert max(sums) <= 2048 and len(windows) <= sum(sizes) // 2048 + 2


def check_packed(rows, docs):
    want = Counter()
    for doc, text in docs:
        want[(doc, len(exact_ids(text)) + 1)] += 1
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[(r.doc_id, r.doc_tokens)].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for key, times in want.items():
        assert sum(r.length for r in pieces[key]) == key[1] * times
    assert set(pieces) == set(want)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return sequences


def test_packing_keeps_every_id_in_one_place(documents):
    docs = brute.corpus(2, 40, 900)
    rows = packing.pack(documents(docs), TOKENIZER, with_ids=True).collect()
    sequences = check_packed(rows, docs)
    texts = dict(docs)
    by_doc = defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc[r.doc_id].append(r)
    for doc, parts in by_doc.items():
        ids = [i for r in sorted(parts, key=lambda r: r.start) for i in r.ids]
        assert ids == exact_ids(texts[doc]) + [1]
    filled = sum(n for parts in sequences.values() for _, n in parts)
    assert filled > 0.9 * 2048 * len(sequences)


def test_packing_odd_rows(documents, odd_rows):
    check_packed(packing.pack(documents(odd_rows), TOKENIZER).collect(), odd_rows)
    assert packing.pack(documents([]), TOKENIZER).count() == 0


# --- token counts -------------------------------------------------------------------------


def test_rollup_is_additive_and_idempotent(spark, documents):
    docs = brute.corpus(3, 20)
    sizes = {d: len(exact_ids(t)) for d, t in docs}
    counts = token_counts.counted(documents(docs), TOKENIZER, "v1").cache()
    store = token_counts.Rollup(spark, scratch_path(spark, "rollup"))
    assert store.totals().count() == 0
    assert store.commit("a", token_counts.signed(counts, 1))
    assert not store.commit("a", token_counts.signed(counts, 1))
    gone = [d for d, _ in docs][:5]
    store.commit("b", token_counts.signed(counts.where(F.col("doc_id").isin(gone)), -1))
    new = counts.withColumn("tokens", F.col("tokens") + 1).where(~F.col("doc_id").isin(gone))
    old = counts.where(~F.col("doc_id").isin(gone))
    store.commit("c", token_counts.revised(old, new))
    want = [("s", "en", "v1", 15, sum(sizes[d] + 1 for d, _ in docs if d not in gone))]
    assert [tuple(r) for r in store.totals().collect()] == want
    assert store.compact("folded") and not store.commit("b", token_counts.signed(counts, -1))
    assert [tuple(r) for r in store.totals().collect()] == want
    assert store.live().select("batch").distinct().count() == 1
    store.commit("empty", token_counts.signed(counts.limit(0), 1))
    store.commit("d", token_counts.signed(new, -1))
    assert store.totals().count() == 0


def test_uncommitted_sums_do_not_count(spark, documents):
    store = token_counts.Rollup(spark, scratch_path(spark, "rollup"))
    counts = token_counts.counted(documents([(1, "a b")]), TOKENIZER, "v1")
    sums = token_counts.signed(counts, 1)
    sums.write.parquet(f"{store.path}/sums/batch=torn")  # a writer that failed before its commit
    assert store.totals().count() == 0
    store.commit("torn", sums)
    assert [r.docs for r in store.totals().collect()] == [1]


def test_counts_of_odd_rows(documents, odd_rows):
    rows = token_counts.counted(documents(odd_rows), TOKENIZER, "v").collect()
    assert Counter((r.doc_id, r.tokens) for r in rows) == Counter(
        (d, len(exact_ids(t))) for d, t in odd_rows
    )


# --- licenses -----------------------------------------------------------------------------


def labels_of(text):
    automata = licenses.compiled(licenses.TEMPLATES)
    phrases = {b" " + p.encode() + b" ": x for p, x in licenses.PHRASES.items()}
    *_, matches = licenses.scan_text(text.encode(), phrases, automata)
    return {m[0] for m in matches}


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Released under the MIT License.", {"mit"}),
        ("released under the terms of the MIT license", {"mit"}),
        ("released under the terms of MIT license", set()),
        ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3.0"}),
        ("It is licensed under the GNU General Public License either version 2", {"gpl-2.0"}),
        ("Licensed under the GNU General Public License, version 3.", set()),
        ("(c) licensed under the GNU General Public License, version 3.", {"gpl-3.0"}),
        ("Copyright (c) 2001-2020 A. B. All rights reserved.", {"copyright"}),
        ("Copyright all rights reserved", set()),
        ("copyright " + "x " * 9 + "all rights reserved", set()),
        ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
        ("Licensed under Apache", set()),
    ],
)
def test_templates(text, labels):
    assert labels_of(text) == labels
    assert labels_of(f"before it. {text}\nAfter it") >= labels - {"copyright"}


def test_license_base_fields(documents, odd_rows):
    rng = random.Random(4)
    words = "cc by general public license all rights reserved x".split()
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    for rows in (docs, odd_rows):
        found = licenses.scan(documents(rows)).collect()
        key = lambda *x: tuple(map(str, x))
        got = sorted(
            key(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
            for r in found
        )
        want = []
        for d, t in rows:
            n, places, labels = brute.phrase_places(t)
            low, high = min(places, default=None), max(places, default=None)
            want.append(key(d, n, len(places), low, high, labels))
        assert got == sorted(want)
        assert all(0 <= r.score <= 1 and set(r.base_labels) <= set(r.labels) for r in found)
    assert licenses.scan(documents([])).count() == 0


# --- personal data ------------------------------------------------------------------------


def personal_texts(seed, n=150):
    rng = random.Random(seed)
    parts = (
        ["a@b.co", "x.y+z@m-1.d.e", "@", "a@b", "..@q.r", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8"]
        + ["+1 (555) 010-9999", "+49-12", "+1234567890123456", "4111 1111 1111 1111", "4111-1111"]
        + ["4111111111111111", "0000000000000", "12 34", "é", "word", " ", "-", "+", "  ", "\n", "."]
        + ["010.0.0.0255", "7", "\U0001f600"]
    )
    return [
        (i, "".join(rng.choice(parts) + rng.choice(["", " ", ","]) for _ in range(rng.randint(0, 25))))
        for i in range(n)
    ]


def test_base_spans(documents, odd_rows):
    for rows in (personal_texts(5), odd_rows):
        found = pii.find(documents(rows)).collect()
        got = sorted(
            (str(r.doc_id), str([(s.kind, s.start, s.end) for s in r.spans if s.kind != "term"]))
            for r in found
        )
        assert got == sorted((str(d), str(brute.personal(t))) for d, t in rows)
    assert pii.find(documents([])).count() == 0


def test_long_runs_do_not_overflow(documents):
    texts = ["1 " * 50_000, "a" * 200_000, "1." * 50_000, "a@" + "b." * 50_000, "+1" + "(" * 100_000]
    rows = list(enumerate(texts))
    found = {r.doc_id: len(r.spans) for r in pii.find(documents(rows)).collect()}
    assert found == {d: len(brute.personal(t)) for d, t in rows}


def disclosing_texts():
    """An address in five texts, always near one rare name; common words around it."""
    rng = random.Random(6)
    common = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(common) for _ in range(80))) for i in range(200)]
    for i in range(5):
        around = [rng.choice(common) for _ in range(6)]
        text = f"{' '.join(around[:3])} Zanthor agent 77041 {' '.join(around[3:])} me@secret.example"
        rows.append((1000 + i, f"{text} {rng.choice(common)} ends"))
    return rows


def test_terms_that_disclose(documents):
    rows = disclosing_texts()
    found = {r.doc_id: r.spans for r in pii.find(documents(rows)).collect()}
    texts = dict(rows)
    for d in range(1000, 1005):
        terms = {texts[d][s.start : s.end] for s in found[d] if s.kind == "term"}
        assert {"Zanthor", "77041"} <= terms and not any(t.startswith("w") for t in terms)
    assert all(not found[d] for d in range(200))
    clean = {r.doc_id: (r.text, r.n_chars) for r in pii.sanitise(documents(rows)).collect()}
    for d, (text, n) in clean.items():
        assert n == len(text)
        if d < 1000:
            assert text == texts[d]
        else:
            assert "[EMAIL]" in text and "[NUMBER]" in text and "[TERM]" in text
            assert "Zanthor" not in text and "secret" not in text


def test_terms_far_from_the_entity_disclose(documents, monkeypatch):
    """A name always forty words from the address; candidates both broadcast and not."""
    rng = random.Random(12)
    common = [f"w{i}" for i in range(30)]
    fill = lambda n: " ".join(rng.choice(common) for _ in range(n))
    rows = [(i, fill(120)) for i in range(200)]
    rows += [(1000 + i, f"Quillon {fill(40)} me@far.example {fill(40)} 90210") for i in range(5)]
    texts = dict(rows)
    for few in (pii.BROADCAST_TERMS, 0):
        monkeypatch.setattr(pii, "BROADCAST_TERMS", few)
        for r in pii.find(documents(rows)).collect():
            terms = {texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind == "term"}
            assert terms == ({"Quillon", "90210"} if r.doc_id >= 1000 else set())


def test_sanitise_keeps_columns_and_odd_rows(documents, odd_rows):
    docs = documents(odd_rows)
    done = pii.sanitise(docs)
    assert done.columns == docs.columns
    assert sorted(map(str, done.collect())) == sorted(map(str, docs.collect()))
    assert pii.sanitise(documents([])).count() == 0


# --- Jaccard ------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("seed", "k", "num", "den", "more"), [(7, 3, 90, 100, 4), (8, 5, 4, 5, 0), (9, 2, 1, 2, 0)]
)
def test_jaccard_classes(documents, monkeypatch, seed, k, num, den, more):
    """With small homes and clusters, so that cells and single pairs take part."""
    monkeypatch.setattr(jaccard, "MEET", 4)
    monkeypatch.setattr(jaccard, "HOME_BYTES", 3000)
    monkeypatch.setattr(jaccard, "MORE_HOMES", more)
    docs = brute.corpus(seed)
    found = jaccard.named(jaccard.classes(documents(docs), k, num, den, block_bytes=4000))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}
    assert got == brute.jaccard_classes(docs, k, num, den)


def test_jaccard_ignores_the_case_of_a_to_z(documents):
    """Copies in capitals link, and a shingle in two casings is one; É and é stay two letters."""
    docs = brute.corpus(11, 30)
    docs += [(1000 + d, t.translate({v: k for k, v in brute.FOLD.items()})) for d, t in docs[:15]]
    docs += [(2000 + d, f"{t.title()} {t}") for d, t in docs[:15]]
    docs += [(3000, "É b c d"), (3001, "é b c d"), (3002, "é B C d")]
    found = jaccard.named(jaccard.classes(documents(docs), 3, 90, 100))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}
    folded = [(d, t.translate(brute.FOLD)) for d, t in docs]
    assert got == brute.jaccard_classes(folded, 3, 90, 100)
    assert got == brute.jaccard_classes(docs, 3, 90, 100)
    assert got != brute.jaccard_classes(docs, 3, 90, 100, fold=False)


def test_linked_finds_every_link():
    rng = random.Random(10)
    base = rng.sample(range(10**6), 60)
    sets = []
    for _ in range(80):
        drop = set(rng.sample(base, rng.randint(0, 8)))
        sets.append(sorted({x for x in base if x not in drop} | {rng.randrange(10**6) for _ in range(3)}))
    group = jaccard.linked([np.array(s, np.uint64).tobytes() for s in sets], 85, 100)
    rows = [(i, s) for i, s in enumerate(sets)]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in rows:
        for j, t in rows[:i]:
            both = len(set(s) & set(t))
            if 100 * both >= 85 * (len(s) + len(t) - both):
                parent[find(i)] = find(j)
    assert len(set(map(find, range(len(rows))))) == len(set(group.tolist()))


def test_jaccard_odd_rows(documents, odd_rows):
    found = jaccard.named(jaccard.classes(documents(odd_rows), 3, 90, 100, block_bytes=2000))
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())
    sizes = {t: len(brute.shingles(t, 3)) for _, t in odd_rows}
    want = Counter()
    for d, t in odd_rows:  # all that have the text of 4 are in its class, with or without id
        want[(d, sizes[t], 4 if t == odd_rows[3][1] else d)] += 1
    assert got == want
    assert jaccard.named(jaccard.classes(documents([]))).count() == 0


def test_keep_one_of_each_class(documents, odd_rows):
    docs = documents(odd_rows)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, (r.text or "")[:20]) for r in kept.collect())
    want = Counter((d, (t or "")[:20]) for d, t in odd_rows)
    same = odd_rows[3][1][:20]
    want.subtract([(4, same), (None, same), (5, same)])
    assert got == +want
    assert jaccard.keep_one(documents([])).count() == 0


def test_roots_of_chains_and_stars(spark):
    rng = random.Random(11)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)]
    names = list(range(200))
    rng.shuffle(names)
    df = spark.createDataFrame([(names[a], names[b]) for a, b in edges], "a bigint, b bigint")
    got = {r.node: r.root for r in roots(df).collect()}
    for part in (range(0, 61), range(100, 140)):
        least = min(names[i] for i in part)
        assert {got.get(names[i], names[i]) for i in part} == {least}
    assert roots(df.limit(0)).count() == 0


# --- decontamination ----------------------------------------------------------------------


@pytest.mark.parametrize("few", [True, False])
def test_contamination(spark, documents, monkeypatch, few):
    if not few:  # the way for benchmarks too large to broadcast
        monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", -1)
    rng = random.Random(12)
    docs = brute.corpus(13)
    items = [(1, None), (2, ""), (None, "one two three four five six seven eight nine ten"), (4, "kara")]
    for i in range(12):
        words = brute.letters(rng.choice(docs)[1])
        size = rng.choice([4, 9, 10, 11, 30])
        if len(words) > size:
            at = rng.randrange(len(words) - size)
            items.append((10 + i, " ".join(words[at : at + size]).upper()))
    docs.append((5000, "zero one two three four five six seven eight nine ten eleven"))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.contamination(documents(docs), bench)
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found.collect()}
    want = brute.contamination(docs, items)
    assert got == want and any(x[1] for x in want.values())
    kept = decontamination.drop_contaminated(documents(docs), bench)
    assert {r.doc_id for r in kept.collect()} == {d for d, x in want.items() if not x[1]}


def test_contamination_across_chunks_and_odd_rows(spark, documents, odd_rows):
    rng = random.Random(14)
    words = [f"v{rng.randrange(10**6)}" for _ in range(2500)]
    odd_rows.append((8, " ".join(words)))
    items = [(i, " ".join(words[at : at + 12])) for i, at in enumerate(range(1000, 1040, 3))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontamination.contamination(documents(odd_rows), bench).collect()
    got = Counter(map(str, ((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in rows)))
    want = Counter()
    for d, t in odd_rows:
        want[str((d, *brute.contamination([(d, t)], items)[d]))] += 1
    assert got == want
    none = bench.limit(0)
    assert decontamination.contamination(documents([]), bench).count() == 0
    assert decontamination.drop_contaminated(documents(odd_rows), none).count() == len(odd_rows)


# --- chat ---------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text", ["", "\\", "a\\b\\\\", "<|turn|>", "<\\|turn|>", "[INST]x[/INST]</s>", "é<|end|>\n"]
)
def test_escape_is_reversible(text):
    safe = chat.escape(text)
    assert chat.unescape(safe) == text
    assert not any(c in safe for c in chat.CONTROLS)


def test_chat_round_trip(spark):
    rng = random.Random(15)
    words = ["hi", "</s>", "[INST]", "\\", "<|end|>", "é", "\n", " ", "\U0001f600"]
    rows = []
    for conv in range(12):
        for turn in range(rng.randint(1, 6)):
            text = "".join(rng.choice(words) for _ in range(rng.randint(0, 12)))
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", None]), text))
    rows += [(None, 0, "assistant", None), (None, 0, "assistant", "b"), (3, None, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    df = df.withColumn("ids", F.lit("clash")).repartition(4)
    made = chat.assemble(df, TOKENIZER)
    got = {r.conv_id: r for r in chat.read_back(made, TOKENIZER).collect()}
    low = lambda x: (x is not None, x)  # noqa: E731  nulls first, as Spark sorts
    groups = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: tuple(map(low, r))):
        groups[conv].append((role or "", text or ""))
    assert set(got) == set(groups)
    for conv, turns in groups.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        r = got[conv]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == brute.sha("".join(f"{a}\n{b}\n" for a, b in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), brute.sha(loss))
        frame = sum(map(len, chat.MARKS.values()))
        size = sum(frame + len(chat.escape(a)) + len(chat.escape(b)) for a, b in turns)
        assert r.formatted_chars == size
    spans = defaultdict(int)
    for r in sorted(made.collect(), key=lambda r: r.start):
        assert r.start == spans[r.conv_id]
        spans[r.conv_id] += len(r.ids)
    empty = chat.assemble(df.limit(0), TOKENIZER)
    assert chat.read_back(empty, TOKENIZER).count() == 0


# --- quality model and rules --------------------------------------------------------------


def test_model_learns_from_positives_and_unlabelled():
    rng = np.random.default_rng(16)
    good = rng.normal(0, 1, (3000, 2))
    bad = rng.normal(3, 1, (600, 2))
    unlabelled = np.concatenate([rng.normal(0, 1, (2400, 2)), bad])
    model = quality_model.fit(good, unlabelled, 0.8)
    high, low = model.score(rng.normal(0, 1, (500, 2))), model.score(rng.normal(3, 1, (500, 2)))
    assert (high >= 0.5).mean() > 0.9 and (low < 0.5).mean() > 0.8


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.85])
def test_prior_without_any_negative(prior):
    rng = np.random.default_rng(25)
    n = 4000
    good = rng.normal(0, 1, (n, 2))
    mixed = np.where(rng.random((n, 1)) < prior, rng.normal(0, 1, (n, 2)), rng.normal(4, 1, (n, 2)))
    assert quality_model.estimated_prior(good, mixed) == pytest.approx(prior, abs=0.06)
    assert quality_model.estimated_prior(good, rng.normal(0, 1, (n, 2))) > 0.9
    assert quality_model.estimated_prior(good[:1], mixed) == quality_model.MOST_PRIOR


def test_gradient_of_the_risk():
    """The fit ends near the least non-negative risk, as found by trying weights one by one."""
    rng = np.random.default_rng(26)
    positive, unlabelled = rng.integers(0, 2, (400, 1)) * 1.0, rng.random((400, 1)).round()
    positive[:300] = 1.0

    def risk(model, prior=0.6):
        p, u = model.score(positive), model.score(unlabelled)
        return prior * (1 - p).mean() + max(0.0, u.mean() - prior * p.mean())

    model = quality_model.fit(positive, unlabelled, 0.6)
    tried = []
    for low in range(-6, 7):
        for high in range(-6, 7):
            other = quality_model.Model(model.edges, [np.zeros(len(model.weights[0]))], 0.0)
            other.weights[0][other.bins(np.array([[0.0]]))[0][0]] = low
            other.weights[0][other.bins(np.array([[1.0]]))[0][0]] = high
            tried.append(risk(other))
    assert risk(model) < min(tried) + 0.02


def test_training_reads_one_row_of_an_id(spark, documents, monkeypatch):
    seen = {}
    monkeypatch.setattr(
        quality_model, "fit", lambda p, u, prior: seen.setdefault("rows", (len(p), len(u)))
    )
    monkeypatch.setattr(quality_model, "estimated_prior", lambda p, u: 0.5)
    rows = [(i % 20, f"text {i} of {i % 7} words") for i in range(400)]
    labels = spark.createDataFrame([(d, 1) for d in range(20)], "doc_id bigint, quality int")
    quality_model.train(documents(rows), labels)
    inside = sum(zlib.crc32(str(d).encode()) % 3 != 1 for d in range(20))
    assert seen["rows"] == (inside, inside)


def test_scores_of_odd_rows(spark, documents, odd_rows):
    labels = spark.createDataFrame(
        [(d, 1, 0) for d in range(1, 8)] + [(None, 1, None)], "doc_id bigint, quality int, toxic int"
    )
    docs = documents(odd_rows)
    rows = quality_model.score(docs, quality_model.train(docs, labels)).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in odd_rows)
    for r in rows:
        assert 0 <= r.score <= 1
        name = "" if r.doc_id is None else str(r.doc_id)
        assert r.held_out == (zlib.crc32(name.encode()) % 3 == 1)
    none = quality_model.train(docs, labels.limit(0))
    assert {r.score for r in quality_model.score(docs, none).collect()} == {0.5}
    assert quality_model.score(documents([]), none).count() == 0


def test_quality_base_counts(documents, odd_rows):
    docs = [(d, f"{t}\n{t[:9]}|#\n{t[:9]}|#") for d, t in brute.corpus(17, 40, 60)]
    for rows in (docs, [r for r in odd_rows if len(r[1] or "") < 10_000]):
        found = quality_rules.quality(documents(rows)).collect()
        got = Counter(
            (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
            for r in found
        )
        assert got == Counter((d, *brute.quality_counts(t)) for d, t in rows)
        for r in found:
            fails = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
            assert r.base_failed == fails and not (fails and r.kept)
    long = quality_rules.quality(documents(odd_rows)).where("doc_id = 6").first()
    assert (long.n_words, long.n_repeat_words, long.kept) == (80_000, 80_000, False)
    assert quality_rules.quality(documents([])).count() == 0


def test_null_language_and_source(documents):
    rows = [(i, f"{i} " + " ".join(f"w{i}x{j}" for j in range(60))) for i in range(6)]
    docs = documents(rows[:3], None, None).unionByName(documents(rows[3:], "en", None))
    found = quality_rules.quality(docs).collect()
    assert {r.doc_id: r.kept for r in found} == {i: True for i in range(6)}
    assert quality_rules.keep_good(docs).count() == 6
    counts = token_counts.counted(docs, TOKENIZER, "v")
    sums = token_counts.signed(counts, 1).groupBy("lang").sum("docs").collect()
    assert {r[0]: r[1] for r in sums} == {None: 3, "en": 3}


def test_sketches_merge_and_limits_adapt(documents):
    rng = random.Random(18)

    def text(symbols):
        words = [f"{rng.randrange(10**6):x}" + "#" * (rng.random() < symbols) for _ in range(80)]
        return " ".join(words)

    calm = documents([(i, text(0.0)) for i in range(300)], source="calm")
    code = documents([(1000 + i, text(0.5)) for i in range(300)], source="code")
    loud = documents([(2000 + i, text(1.0)) for i in range(5)], source="calm")
    both = calm.unionByName(code).unionByName(loud)
    of = ("lang", "source")
    parts = [quality_rules.sketch(quality_rules.measure(x), of) for x in (calm, code, loud)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2])
    merged = merged.groupBy("lang", "source", "ratio", "bin").agg(F.sum("n").alias("n"))
    whole = quality_rules.sketch(quality_rules.measure(both), of)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.select(merged.columns).collect()))
    kept = {r.doc_id for r in quality_rules.quality(both).where("kept").collect()}
    assert kept == set(range(300)) | set(range(1000, 1300))
    passed = quality_rules.keep_good(both)
    assert passed.columns == both.columns and {r.doc_id for r in passed.collect()} == kept


# --- substrings ---------------------------------------------------------------------------


@pytest.mark.parametrize(("seed", "k", "block"), [(19, 50, 6_000_000), (20, 50, 3000), (21, 5, 900)])
def test_substring_dedup(documents, seed, k, block):
    docs = brute.corpus(seed)
    found = substring_dedup.remove_repeats(documents(docs), k, block).collect()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in found}
    assert got == brute.substring_dedup(docs, k)
    for r in found:
        assert sum(x.end - x.start for x in r.removed) == r.n_removed
        ends = [x.end for x in r.removed]
        assert all(a < x.start for a, x in zip(ends, r.removed[1:]))


def test_substring_dedup_odd_rows(documents, odd_rows):
    for block in (6_000_000, 500):
        found = substring_dedup.remove_repeats(documents(odd_rows), 50, block).collect()
        got = Counter((r.doc_id, r.n_words, r.n_removed) for r in found)
        # equal ids keep their text, 5 and the null id lose what 4 has, null removes nothing
        want = Counter((d, len(brute.spaced(t)), 0) for d, t in odd_rows)
        for d in (5, None):
            want[(d, 72, 0)] -= 1
            want[(d, 72, 72)] += 1
        assert got == +want
    assert substring_dedup.remove_repeats(documents([])).count() == 0


@pytest.mark.parametrize("spell", [int, "doc {:06d}".format, "{:x}".format])
@pytest.mark.parametrize("knots", [1024, 3])
def test_substring_dedup_with_any_ids_and_few_knots(spark, monkeypatch, spell, knots):
    """Blocks between knots are even steps of the id; ids of texts go by their bytes."""
    monkeypatch.setattr(blocks, "KNOTS", knots)
    docs = [(spell(d * d), t) for d, t in brute.corpus(24)]
    df = spark.createDataFrame(docs, ["doc_id", "text"]).repartition(3)
    spread, id_blocks, _ = blocks.dealt(df, 2000)
    if knots == 3:
        assert id_blocks > 6 and len({r.block for r in spread.collect()}) > 3
    found = substring_dedup.remove_repeats(df, 20, 2000).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in found} == (
        brute.substring_dedup(docs, 20)
    )


def test_the_plan_holds_few_ids(spark, monkeypatch):
    monkeypatch.setattr(blocks, "KNOTS", 16)
    rows = [(i, f"some words {i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sizes = []
    for block_bytes in (4000, 40):
        spread, id_blocks, _ = blocks.dealt(df, block_bytes)
        blocks_of = spread.groupBy("block").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
        found = blocks_of.orderBy("block").collect()
        assert all(x.b < y.a for x, y in zip(found, found[1:])) and found[-1].block < id_blocks
        sizes.append(len(spread._jdf.queryExecution().optimizedPlan().toString()))
    assert len(found) > 2000 and abs(sizes[1] - sizes[0]) < 2000


# --- texts with very much of one thing ------------------------------------------------------


def within(seconds, run):
    started = time.perf_counter()
    made = run()
    assert time.perf_counter() - started < seconds
    return made


def test_a_turn_of_blanks(spark):
    texts = [" " * 2_000_000, "a" * 1_100_000, "<|endoftext|></s>" * 70_000]
    rows = [(1, i, "assistant", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    [r] = chat.read_back(chat.assemble(df, TOKENIZER), TOKENIZER).collect()
    assert r.loss_chars == sum(map(len, texts)) and r.loss_sha256 == brute.sha("".join(texts))


def test_plain_ids_are_those_of_the_json_file():
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(TOKENIZER)
    exact.encode_special_tokens = True
    for text in ("x <|endoftext|> y", "é \U0001f600", " " * 300):
        ids = exact.encode(text, add_special_tokens=False).ids
        assert Encoder(TOKENIZER).encode_plain(text) == ids


def test_many_phrases_in_one_text():
    text = b"all rights reserved cc by " * 200_000
    phrases = {b" all rights reserved ": "reserved", b" cc by ": "cc-by"}
    n, places, _, _ = within(10, lambda: licenses.scan_text(text, phrases, []))
    assert n == 1_000_000 and sorted(places[:2] + places[-2:]) == [0, 5, 999_993, 999_998]


def test_many_addresses_in_one_text(documents):
    text = "é " + "mail a.b@c.de or " * 100_000
    docs = documents([(1, text)])
    [r] = pii.find(docs).collect()
    assert len(r.spans) == 100_000
    assert [(s.start, s.end) for s in (r.spans[0], r.spans[-1])] == [(7, 15), (1_699_990, 1_699_998)]
    [clean] = within(30, lambda: pii.sanitise(docs).collect())
    assert clean.text == "é " + "mail [EMAIL] or " * 100_000


@pytest.mark.parametrize("size", [0, 1, 255, 256, 257, 1000])
def test_running(spark, size):
    values = [random.Random(size + i).randint(0, 99) for i in range(size)]
    df = spark.createDataFrame([(values,)], "v array<int>")
    [r] = df.select(
        running(F.col("v"), lambda a, b: a + b).alias("sums"),
        running(F.col("v"), F.greatest).alias("most"),
    ).collect()
    assert r.sums == np.cumsum(values).tolist()
    assert r.most == (np.maximum.accumulate(values).tolist() if values else [])


def test_limits_lean_on_the_language_and_this_fades(spark):
    """A group's limit, as its documents grow from few to many, goes from its language's to its own."""
    ratio = "word_length"

    def limit(size):
        rows = [("en", "big", ratio, 10, 10_000), ("en", "own", ratio, 40, size)]
        counts = spark.createDataFrame(rows, "lang string, source string, ratio string, bin int, n bigint")
        [r] = quality_rules.limits(counts).where("source = 'own'").collect()
        return r.limits[ratio]

    own = quality_rules.SMALLEST * quality_rules.BIN_GROWTH**40
    lent = quality_rules.SMALLEST * quality_rules.BIN_GROWTH**10
    found = [limit(size) for size in (1, 30, 60, 100, 200, 100_000)]
    assert found[0] == pytest.approx(lent, rel=0.01) and found[-1] == pytest.approx(own, rel=0.01)
    assert max(found) > own  # in between both are in the quartiles


def test_a_few_events_in_a_short_text_are_no_evidence(documents):
    """Groups without any symbol, or any equal lines, let a few of them pass and many not."""
    rng = random.Random(23)

    def text(*more):
        words = [f"{rng.randrange(10**9):x}" for _ in range(300)]
        return "\n".join(" ".join(words[i : i + 10]) for i in range(0, 300, 10)) + "\n" + "\n".join(more)

    rows = [(i, text()) for i in range(120)]
    rows += [(200, text("a # b # c")), (201, text("twice so", "twice so", "twice so"))]
    rows += [(300, text("# " * 40)), (301, text(*["said it again"] * 60))]
    kept = {r.doc_id for r in quality_rules.quality(documents(rows)).where("kept").collect()}
    assert kept == set(range(120)) | {200, 201}


def test_windows_that_share_their_upper_bits(spark):
    """Equal windows are found where others with the same upper bits lie between them."""
    a, b = (77 << 21) | 5, (77 << 21) | 9
    windows = [a, b, 1 << 40, a, b, 3 << 40]
    df = spark.createDataFrame([(windows,)], "w array<bigint>")
    [r] = df.select(quality_rules._repeated(F.col("w")).alias("n")).collect()
    assert r.n == 7  # the windows at 0, 1, 3 and 4 cover the words 0 to 6
