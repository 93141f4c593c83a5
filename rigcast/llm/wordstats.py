"""Counts over the words and lines of a text, for the quality rules."""

from __future__ import annotations

import numpy as np

from rigcast.llm.textnum import Flat, mix64, runs

SYMBOLS = frozenset(b"#*$%&|<>")
_POWER = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
WINDOW = 5

COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_distinct",
           "top_word", "n_stop_ends", "n_upper", "n_digits", "n_bar_words", "longest_word", "n_adjacent")


def text_stats(texts: list[str | None]) -> dict[str, np.ndarray]:
    """One value per text and name in ``COLUMNS`` (null: the empty text).

    ``n_dup_lines``: lines (split at \\n) holding a word and equal to an
    earlier line; ``n_repeat_words``: words covered by windows of five words
    that occur at least twice in the text; ``n_adjacent``: words equal to the
    word before.
    """
    flat = Flat(texts)
    buf, n = flat.buf, flat.n
    out = {c: np.zeros(n, np.int64) for c in COLUMNS}
    if not n:
        return out
    lo, hi, first = flat.words()
    h, _ = flat.word_hashes()
    out["n_words"] = np.diff(first)

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(mask, dtype=np.int64)[flat.ends - 1]])

    def per_word(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(mask, dtype=np.int64)][first])

    table = np.zeros(256, np.uint8)                   # 1 symbol, 2 starts a character, 4 letter, 8 upper, 16 digit
    for b in SYMBOLS:
        table[b] |= 1
    table[[b for b in range(256) if b & 0xC0 != 0x80]] |= 2
    for a, z in ((65, 90), (97, 122)):
        table[a:z + 1] |= 4
    table[0xC3:0xF5] |= 4
    table[65:91] |= 8
    table[48:58] |= 16
    kind = table[buf]
    gap = (buf == 32) | ((buf >= 9) & (buf <= 13))
    out["n_symbols"] = per_text(kind & 1)
    out["word_chars"] = per_text((kind & 2).astype(bool) & ~gap)
    out["n_letters"], out["n_upper"], out["n_digits"] = per_text((kind & 4) > 0), per_text((kind & 8) > 0), per_text((kind & 16) > 0)
    doc = np.repeat(np.arange(n), out["n_words"])
    if len(h):
        order = np.lexsort((h, doc))
        same = np.r_[True, (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])]
        start = np.flatnonzero(same)
        count = np.diff(np.r_[start, len(h)])
        np.maximum.at(out["top_word"], doc[order][start], count)
        out["n_distinct"] = np.bincount(doc[order][start], minlength=n)
        np.maximum.at(out["longest_word"], doc, hi - lo)
        last = buf[hi - 1]
        out["n_stop_ends"] = per_word((last == 46) | (last == 33) | (last == 63))
        out["n_bar_words"] = per_word(((hi - lo) == 1) & (kind[lo] & 1).astype(bool))
        out["n_adjacent"] = per_word(np.r_[False, (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])])
        out["n_repeat_words"] = _repeated(h, doc, n)
    out["n_dup_lines"], out["n_lines"] = _lines(flat, lo)
    return out


def _repeated(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Words covered by windows found twice or more in their text."""
    if len(h) < WINDOW:
        return np.zeros(n, np.int64)
    w = np.zeros(len(h) - WINDOW + 1, np.uint64)
    for j, p in enumerate(_POWER):
        w += h[j:len(w) + j] * p
    whole = doc[WINDOW - 1:] == doc[:len(w)]
    at = np.flatnonzero(whole)
    key = mix64(mix64(w[at]) + doc[at].astype(np.uint64) * _POWER[0])        # windows of different texts stay apart
    order = np.argsort(key, kind="stable")
    s, e = runs(key[order])
    twice = np.zeros(len(at), bool)
    twice[order] = np.repeat(e - s > 1, e - s)
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    return np.bincount(doc[np.cumsum(cover)[:-1] > 0], minlength=n)


def _lines(flat: Flat, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Duplicate lines and lines with a word, per text."""
    ends = np.flatnonzero(flat.buf == 10)
    starts = np.r_[0, ends[:-1] + 1]
    doc = np.searchsorted(flat.ends, starts, side="right")
    filled = np.searchsorted(lo, ends) > np.searchsorted(lo, starts)
    starts, ends, doc = starts[filled], ends[filled], doc[filled]
    dup = np.zeros(flat.n, np.int64)
    many = np.bincount(doc, minlength=flat.n)
    raw = flat.buf.tobytes()
    for s, e in zip(*runs(doc)):
        if e - s > 1:
            lines = [raw[a:b] for a, b in zip(starts[s:e].tolist(), ends[s:e].tolist())]
            dup[doc[s]] = len(lines) - len(set(lines))
    return dup, many
