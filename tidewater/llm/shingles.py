"""64-bit hashed word shingles of a text and one-permutation sketches of their sets."""

from __future__ import annotations

import numpy as np

_P = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def mix_int(x: int) -> int:
    """mix() of one Python integer, modulo 2 ** 64."""
    x &= 0xFFFFFFFFFFFFFFFF
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
    return x ^ (x >> 31)


def word_hashes(text: str | None) -> np.ndarray:
    """Hash of every word: A-Z lower-cased, words are runs of bytes other than blank and 0x09 to 0x0D."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64)
    start = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    inside = np.arange(len(data)) - np.repeat(start, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _P, np.uint64), dtype=np.uint64)
    return mix(np.add.reduceat((data + np.uint64(1)) * powers[inside], start, dtype=np.uint64) + lengths.astype(np.uint64))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes. A text with fewer words is one shingle; one without words has none."""
    words = word_hashes(text)
    if not len(words):
        return words
    n = max(1, len(words) - width + 1)
    h = np.full(n, len(words) if len(words) < width else width, np.uint64)
    for k in range(min(width, len(words))):
        h = mix(h * _P + words[k : k + n])
    return np.unique(h)


class OnePermutation:
    """Sketches of bins * 1 values: the least hash of every bin, an empty bin taking the value of the first filled bin in its
    own random probing order (optimal densification)."""

    def __init__(self, bands: int, rows: int, seed: int = 1):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        rng = np.random.default_rng(seed)
        self.probes = np.argsort(rng.random((self.bins, self.bins)), axis=1).astype(np.int32)
        self.salt = mix(np.arange(1, bands + 1, dtype=np.uint64) * _P)

    def band_keys(self, hashes: np.ndarray) -> np.ndarray:
        """One key for each band of the set; none for an empty set."""
        if not len(hashes):
            return np.zeros(0, np.int64)
        at = ((hashes >> np.uint64(32)) * np.uint64(self.bins)) >> np.uint64(32)  # grows with the hash, so the first of a bin is its least
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        filled = at[first].astype(np.int64)
        values, has = np.zeros(self.bins, np.uint64), np.zeros(self.bins, bool)
        values[filled], has[filled] = hashes[first], True
        empty = np.flatnonzero(~has)
        if len(empty):
            order = self.probes[empty]
            values[empty] = values[order[np.arange(len(empty)), has[order].argmax(1)]]
        key = self.salt.copy()
        for column in values.reshape(self.bands, self.rows).T:
            key = mix(key * _P + column)
        return key.view(np.int64)
