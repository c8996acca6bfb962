"""Word shingles of whole texts: words are lower-case runs of word characters, a shingle is five of them."""

from __future__ import annotations

import re

import numpy as np
import xxhash

SHINGLE = 5
SIMILARITY = 0.8
_WORD = re.compile(r"\w+")
_ODD = [np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) | 1) for k in range(64)]


def words(text: bytes | None) -> list[str]:
    return _WORD.findall(text.decode("utf-8", "replace").lower()) if text else []


def word_hashes(ws: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))


def grams(h: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of every run of ``size`` word hashes; a shorter text has one shingle, its whole run."""
    if not len(h):
        return h
    size = min(size, len(h))
    n = len(h) - size + 1
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += h[k:k + n] * _ODD[k]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(32)
    return out


def shingle_set(text: bytes | None) -> np.ndarray:
    return np.unique(grams(word_hashes(words(text))))
