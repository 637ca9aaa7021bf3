"""Document quality by positive-unlabelled learning.

The model sees trusted positives and unlabelled web text, no negatives. It minimises the
non-negative unbiased risk: with class prior p, the loss of positives as positive times p,
plus the loss of unlabelled text as negative less that of positives as negative times p, the
latter difference never below zero.

The prior too comes from positives and unlabelled text alone. If a share p of the unlabelled
documents is positive, then any set of documents holds at least p times as large a share of
the unlabelled as of the positives, and exactly that where it holds no negative. A first model, fit on
half of the sample, ranks the other half; of the sets of its top documents, the one with the
least ratio, sampling error included, gives the prior (best-bin estimation).

A document is described by shares of its characters, words and lines. Each is cut into bins
at quantiles of the sample, and the score is a logistic sum of one weight per bin.

Training takes at most ``SAMPLE`` positives and as many unlabelled documents, chosen by a hash
of the id; scoring runs over all documents, in the tasks that read them. The rows with
crc32(id) mod 3 = 1 give neither labels nor text to training. Of rows that share an id,
training reads one, by a hash of the text.

Null text is empty and is scored like other texts. Null ids count as an empty string for the
split. Equal texts get equal scores. Without any positive in the training part all
documents score the prior 0.5. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000  # labelled positives, and unlabelled documents, that training reads at most
BINS = 12
ROUNDS = 400
DOUBT = 0.1  # chance that the sampling error allowed for the prior is exceeded
LEAST_PRIOR, MOST_PRIOR = 0.02, 0.98
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>{}[]\\^~_=+@/")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
FEATURES = (
    "log_words word_length upper digit symbol pipe bang comma stop wide space line_words "
    "distinct doubled dup_lines long_words short_words entropy"
).split()


def describe(text: bytes) -> list[float]:
    """The document's features, in the order of FEATURES."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    n, size = max(1, len(words)), max(1, int(counts.sum()))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = max(1, int(counts[_LOWER | _UPPER].sum() + counts[128:].sum()))
    share = counts[counts > 0] / size
    doubled = sum(map(bytes.__eq__, words[1:], words[:-1]))
    return [
        float(np.log1p(len(words))),
        float(lengths.mean()) if len(words) else 0.0,
        counts[_UPPER].sum() / letters,
        counts[_DIGIT].sum() / size,
        counts[_SYMBOL].sum() / size,
        counts[124] / n,
        counts[33] / n,
        counts[44] / n,
        counts[46] / n,
        counts[128:].sum() / size,
        counts[32] / size,
        float(np.log1p(len(words) / max(1, len(lines)))),
        len(set(words)) / n,
        doubled / n,
        1 - len(set(lines)) / max(1, len(lines)),
        float((lengths > 12).sum()) / n,
        float((lengths < 4).sum()) / n,
        float(-(share * np.log2(share)).sum()) if len(text) else 0.0,
    ]


def described(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and each document's features as an array."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).cast(pa.binary()).to_pylist()
            found = [describe(t or b"") for t in texts]
            arrays = [batch.column(k) for k in range(len(keep))]
            arrays.append(pa.array(found, pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "features"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    head = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(rows, f"{head}, features array<double>")


@dataclass
class Model:
    """Bin edges of each feature, a weight for each bin, and the intercept."""

    edges: list[np.ndarray]
    weights: list[np.ndarray]
    intercept: float

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)]

    def logits(self, bins: list[np.ndarray]) -> np.ndarray:
        return self.intercept + sum(w[b] for w, b in zip(self.weights, bins))

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.logits(self.bins(x)), -30, 30)
        return 1 / (1 + np.exp(-z))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative risk by gradient steps (Adam) over all rows at once."""
    both = np.concatenate([positive, unlabelled])
    edges = [
        np.unique(np.quantile(both[:, k], np.linspace(0, 1, BINS + 1)[1:-1]))
        for k in range(both.shape[1])
    ]
    model = Model(edges, [np.zeros(len(e) + 1) for e in edges], 0.0)
    p_bins, u_bins = model.bins(positive), model.bins(unlabelled)
    sizes = [len(w) for w in model.weights]
    ends = np.cumsum(sizes)
    flat, first, second = np.zeros(ends[-1] + 1), 0.0, 0.0
    for step in range(1, ROUNDS + 1):
        model.weights, model.intercept = np.split(flat[:-1], ends[:-1]), float(flat[-1])
        # the sigmoid loss: of a positive as positive 1 - s, as negative s
        sp = 1 / (1 + np.exp(-np.clip(model.logits(p_bins), -30, 30)))
        su = 1 / (1 + np.exp(-np.clip(model.logits(u_bins), -30, 30)))
        negative = su.mean() - prior * sp.mean()
        dp, du = sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
        if negative >= 0:
            gp, gu = -prior * dp - prior * dp, du
        else:  # step back from the part that fits noise
            gp, gu = prior * dp, -du
        grad = np.concatenate(
            [
                np.bincount(p_bins[k], gp, sizes[k]) + np.bincount(u_bins[k], gu, sizes[k])
                for k in range(len(sizes))
            ]
            + [[gp.sum() + gu.sum()]]
        ) + 1e-4 * flat
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        flat = flat - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return model


def best_bin(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The least ratio of the shares of unlabelled and of positive scores above a threshold.

    Each threshold's ratio is judged with its sampling error, as small sets have small ratios
    by chance, and returned without.
    """
    p, u = np.sort(positive), np.sort(unlabelled)
    cuts = np.unique(p)
    of_p = 1 - np.searchsorted(p, cuts) / len(p)
    of_u = 1 - np.searchsorted(u, cuts) / len(u)
    error = np.sqrt(np.log(4 / DOUBT) / 2) * (len(u) ** -0.5 + len(p) ** -0.5)
    ratio = of_u / of_p
    return float(ratio[np.argmin(ratio + error / of_p)])


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in the unlabelled rows, from one half's ranking by the other's model."""
    if min(len(positive), len(unlabelled)) < 2:
        return MOST_PRIOR
    ranking = fit(positive[::2], unlabelled[::2], 0.5)
    found = best_bin(ranking.score(positive[1::2]), ranking.score(unlabelled[1::2]))
    return min(MOST_PRIOR, max(LEAST_PRIOR, found))


def held_out(id_column: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))), F.lit(3)) == 1


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on bounded samples of the training part; None without positives or text."""
    training = labels.where(~held_out()).where("quality = 1")
    rank = F.xxhash64("doc_id", F.lit("sample"))
    chosen = training.select("doc_id").distinct().orderBy(rank).limit(sample)
    others = docs.where(~held_out()).select("doc_id").distinct().orderBy(rank).limit(sample)
    named = chosen.withColumn("trusted", F.lit(True)).union(others.withColumn("trusted", F.lit(False)))
    texts = (
        docs.select("doc_id", "text")
        .join(F.broadcast(named), "doc_id")  # 2 * sample ids
        .groupBy("doc_id", "trusted")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    )
    rows = sorted(
        (r.trusted, r.doc_id, r.features)
        for r in described(texts, ["doc_id", "trusted"]).collect()
    )
    x = {t: np.array([r[2] for r in rows if r[0] == t]) for t in (True, False)}
    if not len(x[True]) or not len(x[False]):
        return None
    return fit(x[True], x[False], estimated_prior(x[True], x[False]))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, score) for every document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            x = np.array([describe(t or b"") for t in texts]).reshape(-1, len(FEATURES))
            made = np.full(len(x), 0.5) if model is None else model.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(made)], ["doc_id", "held_out", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(scored, f"doc_id {kind}, held_out boolean, score double")
