"""Sets of hashed n-grams of whole texts."""

from __future__ import annotations

import numpy as np

from rigcast.llm.textnum import Flat, mix64, runs

_K = np.uint64(0x9E3779B97F4A7C15)
ROWS = 128           # texts in one presence bitmap


def byte_grams(flat: Flat, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Text index and hashed feature of each n-gram of UTF-8 bytes that lies in one text."""
    b = flat.buf
    doc = np.repeat(np.arange(flat.n, dtype=np.int32), flat.lengths + 1)
    if len(b) < n:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    h = np.zeros(len(b) - n + 1, np.uint32)
    for j in range(n):
        h = h * np.uint32(0x01000193) + b[j:len(b) - n + 1 + j]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    inside = np.arange(n, len(b) + 1) < flat.ends[doc[:len(h)]]
    return doc[:len(h)][inside], ((h + np.uint32(n * 7919)) % np.uint32(width)).astype(np.int64)[inside]


def word_grams(flat: Flat, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features of words, pairs of words, and n-grams of the marks "this pair of
    words occurred before" and "same word as before" for n = 1, 2, 4 ... 128."""
    h, first = flat.word_hashes()
    doc = np.repeat(np.arange(flat.n, dtype=np.int32), np.diff(first))
    if not len(h):
        return []
    mod = np.uint64(width)
    out = [(doc, (h % mod).astype(np.int64))]
    together = doc[1:] == doc[:-1]
    pair = mix64(h[:-1] * _K + h[1:])
    out.append((doc[1:][together], (pair[together] % mod).astype(np.int64)))
    key = mix64(pair + doc[1:].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    _, where = np.unique(key, return_index=True)
    seen = np.ones(len(key), bool)
    seen[where] = False
    for kind, mark in enumerate((np.r_[False, seen & together], np.r_[False, (h[1:] == h[:-1]) & together])):
        lo, hi = runs(doc * 2 + mark)
        on = mark[lo]
        for step in range(8):
            long = on & (hi - lo >= 1 << step)
            out.append((doc[lo[long]], np.full(int(long.sum()), int(mix64(np.array([kind * 64 + step + 1], np.uint64))[0] % mod))))
    return out


def presence(flat: Flat, features: list[tuple[np.ndarray, np.ndarray]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of every text: ``(ids, first)``, text i owning ``ids[first[i]:first[i + 1]]``."""
    ids, count = [], []
    cuts = [np.searchsorted(d, np.arange(0, flat.n + ROWS, ROWS)) for d, _ in features]
    for i, at in enumerate(range(0, flat.n, ROWS)):
        rows = min(ROWS, flat.n - at)
        seen = np.zeros((rows, width), bool)
        for (d, f), c in zip(features, cuts):
            seen[d[c[i]:c[i + 1]] - at, f[c[i]:c[i + 1]]] = True
        flatat = np.flatnonzero(seen)
        ids.append(flatat % width)
        count.append(np.bincount(flatat // width, minlength=rows))
    if not ids:
        return np.empty(0, np.int64), np.zeros(1, np.int64)
    return np.concatenate(ids), np.r_[0, np.cumsum(np.concatenate(count))]
