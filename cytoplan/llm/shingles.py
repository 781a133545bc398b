"""Hashes of words and word n-grams, by the array."""

from __future__ import annotations

import numpy as np
import xxhash

#: Distinct words that a task remembers the hashes of.
CACHE_WORDS = 150_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64


class WordHashes(dict):
    """word -> 64-bit hash; remembers a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """The same hashes with nothing remembered: faster where many words are met once."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """The runs of bytes other than ASCII white space, A-Z lower-cased if asked for."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    return (raw.lower() if lower else raw).split()


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _MIX
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, in order."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = (out ^ (out >> _U(31))) * _MIX + h[j : j + n]
    return mix(out)


def distinct(v: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorts at once, as np.unique may not."""
    v = np.sort(v)
    return np.concatenate([v[:1], v[1:][v[1:] != v[:-1]]])


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours."""
    done = 1
    while done < w:
        step = min(done, w - done)
        v = np.minimum(v[:-step], v[step:])
        done += step
    return v
