"""Vectorised text helpers shared by the operators of this subpackage.

A batch of texts is laid out as one flat UTF-8 byte array, so that words,
word hashes and shingles of all its texts come from a few numpy passes.
Words are maximal runs of characters other than space and \\t..\\r
(``[^\\x20\\x09-\\x0D]+``); these separators are ASCII, so the byte view and
the character view agree.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.default_rng(20240817)
_BYTE = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_POS = (_RNG.integers(1, 2**62, size=16, dtype=np.uint64) << np.uint64(1)) + np.uint64(1)

BATCH_BYTES = 2 << 20     # bytes of text handled at once; a longer text is a batch of its own


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int = BATCH_BYTES, keep: bool = False) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about ``limit`` bytes of ``text`` (at least one row each).
    What an earlier step holds in this worker is let go, unless ``keep`` says that it is this step's own."""
    if not keep:
        let_go()
    for b in batches:
        if not b.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(b.column(text)), 0), np.int64) + 1
        part = (np.cumsum(size) - size) // limit
        for lo, hi in zip(*runs(part)):
            yield b.slice(int(lo), int(hi - lo))
    give_back()


def give_back() -> None:
    """Hand freed memory back to the system at the end of a task, so that a
    reused worker does not hold the peak of an earlier stage (glibc only)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


_HELD: dict[str, Any] = {}


def held(step: str, make: Callable[[], Any]) -> Any:
    """What a worker holds from one task of ``step`` to the next, such as a
    table of known words; what another step held there is let go."""
    if step not in _HELD:
        let_go()
        _HELD[step] = make()
    return _HELD[step]


def let_go() -> None:
    """Free what a step holds in this worker. Workers outlive steps, so a later
    step would carry that memory besides its own."""
    if _HELD:
        _HELD.clear()
        gc.collect()          # a tokenizer and its tables refer to each other
        give_back()


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of equal neighbours."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    lo = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return lo, np.r_[lo[1:], len(keys)]


class Flat:
    """Bytes of several texts, each followed by one line feed; null texts are empty."""

    def __init__(self, texts: Iterable[str | None], lower: bool = False):
        raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        self.lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        self.ends = np.cumsum(self.lengths + 1)
        self.starts = self.ends - self.lengths - 1
        buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8) if raw else np.empty(0, np.uint8)
        if lower:
            buf = buf + (((buf >= 65) & (buf <= 90)).astype(np.uint8) << np.uint8(5))
        self.buf = buf
        self.n = len(raw)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of every word and, per text, the index of its first word (n + 1 entries)."""
        b = self.buf
        gap = (b == 32) | ((b >= 9) & (b <= 13))
        edge = np.flatnonzero(np.diff(np.r_[True, gap, True].view(np.int8)))
        lo, hi = edge[0::2], edge[1::2]
        first = np.searchsorted(lo, np.r_[self.starts, len(b)])
        return lo, hi, first

    def word_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """A 64-bit hash of every word, and each text's first word."""
        lo, hi, first = self.words()
        if not len(lo):
            return np.empty(0, np.uint64), first
        length = hi - lo
        top = int(length.max())
        power = np.ones(top, np.uint64)
        power[1:] = _STEP
        power = np.multiply.accumulate(power)
        word = np.repeat(np.arange(len(lo)), length)
        within = np.arange(len(word)) - np.repeat(np.cumsum(length) - length, length)
        val = _BYTE[self.buf[within + lo[word]]] * power[within]
        return mix64(np.add.reduceat(val, np.cumsum(length) - length) + length.astype(np.uint64)), first


def shingles(texts: Iterable[str | None], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingle hashes (A-Z lower-cased) of every text.

    Returns ``(tokens, first)``: text i owns ``tokens[first[i]:first[i+1]]``,
    ascending and distinct. A text of fewer than ``k`` words has one token for
    its whole word sequence; a text without words has none.
    """
    flat = Flat(texts, lower=True)
    h, first = flat.word_hashes()
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(flat.n), count)
    if not len(doc):
        return np.empty(0, np.uint64), np.zeros(flat.n + 1, np.int64)
    at = first[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    short = (n < k)[doc]
    hp = np.r_[h, np.zeros(k, np.uint64)]
    left = n[doc]
    tok = np.zeros(len(doc), np.uint64)
    for j in range(k):
        part = hp[at + j] * _POS[j]
        tok += np.where(short & (j >= left), np.uint64(0), part) if short.any() else part
    tok += np.where(short, left.astype(np.uint64) + np.uint64(1), np.uint64(0))
    tok = mix64(tok)
    order = np.lexsort((tok, doc))
    tok, doc = tok[order], doc[order]
    keep = np.r_[True, (tok[1:] != tok[:-1]) | (doc[1:] != doc[:-1])]
    tok, doc = tok[keep], doc[keep]
    return tok, np.searchsorted(doc, np.arange(flat.n + 1))
