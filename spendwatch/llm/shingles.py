"""Hashed word shingles, in numpy inside tasks."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words, kept up to ``most`` words."""

    def __init__(self, most: int = 500_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def words(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, with A-Z lowered (what bytes methods do)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(text: str | None, hashes: WordHashes, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer words is one shingle, one without words has none."""
    ws = words(text)
    if not ws:
        return np.empty(0, np.uint64)
    if len(ws) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(ws), seed=len(ws))], np.uint64)
    w = np.fromiter(map(hashes.__getitem__, ws), np.uint64, len(ws))
    n = len(w) - size + 1
    h = w[:n].copy()
    for k in range(1, size):
        h *= _MULTIPLIER
        h += w[k : k + n]
    h = mixed(h)
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))
