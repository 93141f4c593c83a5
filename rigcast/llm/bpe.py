"""Byte-pair encoding and decoding by batched numpy merge rounds (operator 9).

The symbols of many words lie in one flat array. In each round all adjacent
pairs are looked up at once by binary search over the sorted pair keys, every
word merges its lowest-ranked pair wherever it occurs, and words without a
known pair leave. Decoding gathers the byte strings of the ids from one flat
buffer.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigcast.llm.common import small_batches, table
from rigcast.llm.textnum import chunks, runs
from rigcast.llm.wordcache import PieceTable

# The split pattern of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NO_PAIR = np.iinfo(np.int64).max


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """A byte-level BPE vocabulary read from a ``tokenizers`` JSON file.

    Encodes as that library with ``add_special_tokens=False``: strings of
    special tokens inside a text become their ids.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        by_char = byte_symbols()
        size = max([*vocab.values(), *self.special.values()]) + 1
        raw: list[bytes] = [b""] * size
        for t, i in vocab.items():
            raw[i] = bytes(by_char[c] for c in t) if all(c in by_char for c in t) else t.encode()
        for t, i in self.special.items():
            raw[i] = t.encode()
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_len = np.array([len(r) for r in raw], np.int64)
        self.raw_at = np.cumsum(self.raw_len) - self.raw_len
        self.byte_id = np.zeros(256, np.int64)
        for c, b in by_char.items():
            self.byte_id[b] = vocab[c]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.size = size
        key = left * size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.rank, self.made = key[order], order.astype(np.int64), made[order]
        # a token with one recipe cannot start a pair that ranks before it, so all
        # occurrences of a word's best pair can merge in one round
        self.together = len(np.unique(made)) == len(made)
        self.split = regex.compile(PATTERN)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pieces = PieceTable(self._encode_pieces)

    # ---------------------------------------------------------------- merges

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one flat array, and the number of ids of each word."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), length)
        done_sym, done_word = [], []
        while len(sym):
            key = sym[:-1] * self.size + sym[1:]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            rank = np.full(len(sym), NO_PAIR)
            rank[:-1] = np.where((self.keys[at] == key) & (word[1:] == word[:-1]), self.rank[at], NO_PAIR)
            lo, hi = runs(word)
            best = np.repeat(np.minimum.reduceat(rank, lo), hi - lo)
            over = best == NO_PAIR
            if over.any():
                done_sym.append(sym[over])
                done_word.append(word[over])
            hit = np.flatnonzero((rank == best) & ~over)
            if not len(hit):
                break
            first, last = runs(hit - np.arange(len(hit)))          # x x x: merge every second pair of a run
            within = np.arange(len(hit)) - np.repeat(first, last - first)
            hit = hit[within % 2 == 0]
            if not self.together:
                hit = hit[runs(word[hit])[0]]
            sym[hit] = self.made[at[hit]]
            keep = ~over
            keep[hit + 1] = False
            sym, word = sym[keep], word[keep]
        if not done_sym:
            return np.empty(0, np.int64), np.zeros(len(words), np.int64)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(words))

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words, owner, fixed = [], [], {}
        for i, p in enumerate(pieces):
            if p in self.special:
                fixed[len(words)] = self.special[p]
                words.append(b"")
                owner.append(i)
                continue
            for w in self.split.findall(p):
                words.append(w.encode("utf-8", "surrogatepass"))
                owner.append(i)
        ids, n = self.merge_words(words)
        if fixed:
            at = np.fromiter(fixed, np.int64)
            ids = np.insert(ids, (np.cumsum(n) - n)[at], np.fromiter(fixed.values(), np.int64))
            n[at] = 1
        return ids, np.bincount(np.array(owner, np.int64), weights=n, minlength=len(pieces)).astype(np.int64)

    # ------------------------------------------------------- whole texts

    def _split(self, text: str) -> list[str]:
        parts = self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]
        out: list[str] = []
        for i, p in enumerate(parts):
            if i % 2:
                out.append(p)
            else:
                out += _PIECE.findall(p)
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the number of ids of each (null: none)."""
        return self.pieces.lookup([self._split(t) if t else [] for t in texts])

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[bytes]:
        """UTF-8 of each decoded text; bytes that form no character become U+FFFD."""
        length = self.raw_len[ids]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.raw[np.repeat(self.raw_at[ids] - (ends - length), length) + np.arange(total)].tobytes()
        out, at = [], 0
        for e in np.r_[0, ends][np.cumsum(n)].tolist():
            b = flat[at:e]
            at = e
            try:
                b.decode("utf-8")
            except UnicodeDecodeError:
                b = b.decode("utf-8", "replace").encode()
            out.append(b)
        return out


# A run without white space, with one space before it: the split pattern never
# joins characters of two such pieces, so their ids can be found piece by piece.
_PIECE = regex.compile(r" ?\S+|\s+(?!\S)|\s+")


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", arrays: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` per row, with
    ``arrays`` also ``ids`` and ``decoded``.

    Null and empty texts have no ids and decode to the empty text. Repeated
    rows and null ids are kept as they are; extra columns are ignored. ``path``
    must be readable on every executor.
    """
    small_batches(docs.sparkSession)
    columns = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if arrays else "")

    def run(batches):
        bpe = load(path)
        for b in chunks(batches, "text"):
            ids, n = bpe.encode(b.column("text").to_pylist())
            ends = np.cumsum(n)
            cut = list(zip((ends - n).tolist(), ends.tolist()))
            raw = ids.astype("<u4").tobytes()
            decoded = bpe.decode(ids, n)
            out = {"doc_id": b.column("doc_id"), "n_tokens": pa.array(n, pa.int64()),
                   "ids_sha256": [hashlib.sha256(raw[4 * s:4 * e]).hexdigest() for s, e in cut],
                   "decoded_sha256": [hashlib.sha256(d).hexdigest() for d in decoded]}
            if arrays:
                out |= {"ids": pa.array([ids[s:e].astype(np.int32) for s, e in cut], pa.list_(pa.int32())),
                        "decoded": [d.decode() for d in decoded]}
            yield pa.RecordBatch.from_pydict(out)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, columns)


def op9_bpe(spark, sf_dir, path: str | None = None):
    """Byte-level BPE ids of every whole text, and the text decoded from them."""
    import public_tokenizers
    return encode_decode(table(spark, sf_dir, "documents"), path or public_tokenizers.path("byte_bpe_50k.json"))
