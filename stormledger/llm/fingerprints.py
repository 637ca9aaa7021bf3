"""Vectorised hashes of words and of word windows, for use inside tasks.

Texts are handled as UTF-8 bytes. A word's hash is a polynomial of its bytes, a window's a
polynomial of its words' hashes (Rabin-Karp), both modulo 2^64 and mixed afterwards. Bytes
are taken in pieces of about a megabyte, cut between words.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

PIECE_BYTES = 1 << 20
_RANDOM = np.random.default_rng(20240601)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MASK = (1 << 64) - 1


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0 .. base^size and their inverses modulo 2^64."""
    made = []
    for b in (base, pow(base, -1, 1 << 64)):
        powers = np.full(size + 1, b, np.uint64)
        powers[0] = 1
        made.append(np.multiply.accumulate(powers))
    return made[0], made[1]


def _upto(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(base, 1 << max(16, (size - 1).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of the low bits over all (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(values: np.ndarray, base: int) -> np.ndarray:
    """s with s[j] - s[i] = sum of values[k] * base^k for i <= k < j."""
    powers, _ = _upto(base, len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=sums[1:])
    return sums


def _piece_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words in a piece of bytes."""
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    sums = _sums(_BYTE[data], _BYTE_BASE)
    inverse = _upto(_BYTE_BASE, len(data))[1]
    raw = (sums[ends] - sums[starts]) * inverse[starts]
    return starts, mix(raw + (ends - starts).astype(np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin (len + 1 offsets)."""
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    text_at = np.concatenate(([0], np.cumsum(lengths)))
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8) if texts else np.zeros(0, np.uint8)
    starts, hashes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(data):
        end = min(at + PIECE_BYTES, len(data))
        while end < len(data):  # move on to the next space
            ahead = np.flatnonzero(_SPACE[data[end : end + 4096]])
            if len(ahead):
                end += int(ahead[0])
                break
            end = min(end + 4096, len(data))
        s, h = _piece_words(data[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    places = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(places, text_at)


def windows(hashes: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of first word, hash) of every window of so many words within one text."""
    n = len(hashes) - words + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = np.ones(n, bool)
    for k in range(1, words):  # windows that would begin so near a text's end
        cut = offsets[1:-1] - k
        inside[cut[(cut >= 0) & (cut < n)]] = False
    sums = _sums(hashes, _WORD_BASE)
    inverse = _upto(_WORD_BASE, len(hashes))[1]
    raw = (sums[words:] - sums[:-words]) * inverse[:n]
    places = np.flatnonzero(inside)
    return places, mix(raw[places])


def pack_planes(values: np.ndarray) -> bytes:
    """Bytes of the values plane by plane: sorted values compress well this way."""
    size = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, size).T).tobytes()


def unpack_planes(data: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)
