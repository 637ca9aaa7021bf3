"""Counters as two arrays, sorted keys and their counts, for use inside tasks."""

from __future__ import annotations

import numpy as np

Run = tuple[np.ndarray, np.ndarray]


def added(runs: list[Run]) -> Run:
    """The counters of all runs together; there is at least one run."""
    keys = np.concatenate([k for k, _ in runs])
    counts = np.concatenate([c for _, c in runs])
    order = np.argsort(keys, kind="stable")  # quick, as every run is sorted
    keys = keys[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def tallied(keys: np.ndarray) -> Run:
    """Counters of keys in any order."""
    found, counts = np.unique(keys, return_counts=True)
    return found, counts.astype(np.int64)
