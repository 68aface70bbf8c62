"""Hashed character n-gram and word features of one text, as numpy index arrays."""

from __future__ import annotations

import numpy as np

_MUL = np.uint32(0x01000193)
_MIX = np.uint32(0x9E3779B1)


def text_bytes(text: str | None) -> np.ndarray:
    """Lower-cased UTF-8 bytes with white space as single blanks and a blank at both ends; one blank for an empty text."""
    words = (text or "").lower().encode("utf-8", "replace").split()
    return np.frombuffer(b" " + b" ".join(words) + b" " if words else b" ", dtype=np.uint8)


def char_grams(data: np.ndarray, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """Bucket of every n-gram of every order (with repeats); empty when the text is shorter than the least order."""
    wide = data.astype(np.uint32) + np.uint32(1)
    found, h = [], np.full(len(wide), 0x811C9DC5, np.uint32)
    for n in range(1, max(orders) + 1):
        if len(wide) < n:
            break
        h = (h[: len(wide) - n + 1] ^ wide[n - 1 :]) * _MUL
        if n in orders:
            found.append((h * _MIX) >> np.uint32(32 - bits))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def word_buckets(data: np.ndarray, bits: int) -> np.ndarray:
    """Bucket of every blank-separated word (with repeats)."""
    blank = data == 32
    start = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    if not len(start):
        return np.zeros(0, np.uint32)
    at = np.arange(len(data))
    inside = at - np.maximum.accumulate(np.where(blank, at, 0))
    powers = np.cumprod(np.full(int(inside.max()) + 1, _MUL, np.uint32), dtype=np.uint32)
    terms = np.where(blank, np.uint32(0), (data.astype(np.uint32) + np.uint32(7)) * powers[inside])
    return (np.add.reduceat(terms, start, dtype=np.uint32) * _MIX) >> np.uint32(32 - bits)


class Distinct:
    """Distinct buckets of an index array in linear time, with one reused table."""

    def __init__(self, bits: int):
        self.last = np.zeros(1 << bits, np.int64)

    def __call__(self, idx: np.ndarray) -> np.ndarray:
        at = np.arange(len(idx))
        self.last[idx] = at
        return idx[self.last[idx] == at]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))
