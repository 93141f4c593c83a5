"""Token ids of whole texts from a table of the ids of their distinct pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import chain, islice

import numpy as np
import pyarrow as pa


class _Numbers(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


class PieceTable:
    """Ids of text pieces, filled by ``encode(new_pieces) -> (flat ids, lengths)``.

    A worker keeps it between batches. Beyond ``limit`` pieces only the first
    quarter stays (common pieces come early), so its memory is bounded;
    results do not depend on it.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 300_000):
        self.encode, self.limit = encode, limit
        self.index = _Numbers()
        self.ids = np.empty(0, np.uint32)
        self.length = np.empty(0, np.int64)
        self.start = np.empty(0, np.int64)

    def lookup(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and the number of ids of each text."""
        n = np.fromiter(map(len, texts), np.int64, len(texts))
        return self._gather(self._numbers(chain.from_iterable(texts), int(n.sum())), n)

    def lookup_arrow(self, texts: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """The same for an Arrow list of strings per text; each distinct piece is looked up once."""
        coded = texts.flatten().dictionary_encode()
        number = self._numbers(coded.dictionary.to_pylist(), len(coded.dictionary))
        return self._gather(number[np.asarray(coded.indices)], np.asarray(texts.value_lengths(), np.int64))

    def _numbers(self, pieces: Iterable[str], count: int) -> np.ndarray:
        if len(self.index) > self.limit:
            kept = self.limit // 4
            self.index = _Numbers(islice(self.index.items(), kept))
            self.start, self.length = self.start[:kept].copy(), self.length[:kept].copy()
            self.ids = self.ids[:int(self.length.sum())].copy()
        base = len(self.index)
        at = np.fromiter(map(self.index.__getitem__, pieces), np.int64, count)
        if len(self.index) > base:
            ids, length = self.encode(list(islice(self.index, base, None)))
            self.start = np.r_[self.start, len(self.ids) + np.cumsum(length) - length]
            self.ids = np.r_[self.ids, ids.astype(np.uint32)]
            self.length = np.r_[self.length, length]
        return at

    def _gather(self, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        length = self.length[at]
        ends = np.cumsum(length)
        where = np.repeat(self.start[at] - (ends - length), length)
        where += np.arange(len(where))
        flat = self.ids[where]
        upto = np.r_[0, ends][np.cumsum(n)]
        return flat, np.diff(np.r_[0, upto])
