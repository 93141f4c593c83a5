"""Language ID by a string kernel (operator 8).

The blended-spectrum presence kernel of two texts counts the n-grams (of one
to four UTF-8 bytes, ASCII letters lower-cased) found in both, over the root
of the product of their numbers of n-grams. Kernel ridge regression, one
language versus the rest, is fitted on Nystrom landmarks: with K the sample by
landmark and M the landmark by landmark kernel matrix it solves
``(K'K + ridge * n * M) A = K'Y``. A text's outputs are its kernel values
against the landmarks times A; as the kernel is a product of presence rows,
landmarks and A are multiplied once and texts are scored in batches by one
matrix product with the result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigcast.llm.common import add_columns, small_batches, table
from rigcast.llm.ngrams import byte_grams, presence
from rigcast.llm.textnum import Flat, chunks

WIDTH = 1 << 14      # hashed n-grams
GRAMS = (1, 2, 3, 4)
SAMPLE = 2400        # expected training rows, shared out evenly to the languages
LANDMARKS = 240      # of them
RIDGE = 1e-4
SHARPNESS = 4.0      # of the score: soft maximum over the languages' outputs
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    flat = Flat(texts, lower=True)
    return presence(flat, [byte_grams(flat, n, WIDTH) for n in GRAMS], WIDTH)


def letters(texts: list[str | None]) -> dict[str, list]:
    return {"letter": [bool(t and _LETTER.search(t)) for t in texts]}


@dataclass
class Model:
    langs: list[str]
    weight: np.ndarray        # n-gram by language: landmarks times coefficients

    def predict(self, texts: list[str | None]) -> dict[str, list]:
        lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if self.langs:
            ids, first = grams(texts)
            out = np.zeros((len(texts), len(self.langs)))
            has = np.flatnonzero(np.diff(first) > 0)
            if len(has):
                out[has] = np.add.reduceat(self.weight[ids], first[:-1][has], axis=0) / np.sqrt(np.diff(first)[has])[:, None]
            p = np.exp(SHARPNESS * (out - out.max(axis=1, keepdims=True)))
            p /= p.sum(axis=1, keepdims=True)
            for i, (t, j) in enumerate(zip(texts, p.argmax(axis=1).tolist())):
                if t and _LETTER.search(t):
                    lang[i], score[i] = self.langs[j], float(p[i, j])
        return {"lang_pred": lang, "lang_score": score}


def _rows(packed: list[bytes]) -> np.ndarray:
    """Presence rows over the root of their sums, from packed bits."""
    x = np.unpackbits(np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1), axis=1).astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


def train(langs: list[str], packed: list[bytes], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nystrom kernel ridge regression on packed presence rows."""
    names = sorted(set(langs))
    if not names:
        return Model([], np.zeros((WIDTH, 0)))
    y = np.array([[1.0 if a == b else -1.0 for b in names] for a in langs])
    turn = {n: 0 for n in names}
    rank = []
    for a in langs:                                  # landmarks: the languages in turn
        rank.append(turn[a])
        turn[a] += 1
    chosen = sorted(range(len(langs)), key=lambda i: (rank[i], langs[i]))[:max(landmarks, len(names))]
    mark = _rows([packed[i] for i in chosen])
    k = np.concatenate([_rows(packed[i:i + 256]) @ mark.T for i in range(0, len(packed), 256)]).astype(np.float64)
    m = (mark @ mark.T).astype(np.float64)
    a = np.linalg.solve(k.T @ k + ridge * len(y) * m + 1e-8 * np.eye(len(m)), k.T @ y)
    return Model(names, mark.T.astype(np.float64) @ a)


def _pack(batches):
    schema = pa.schema([("lang", pa.string()), ("id", pa.int64()), ("bits", pa.binary())])
    for b in chunks(batches, "text", 1 << 20):
        ids, first = grams(b.column("text").to_pylist())
        bits = []
        for s, e in zip(first[:-1].tolist(), first[1:].tolist()):
            row = np.zeros(WIDTH, np.uint8)
            row[ids[s:e]] = 1
            bits.append(np.packbits(row).tobytes())
        yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("id"), pa.array(bits, pa.binary())], schema=schema)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from ``docs(id, text, lang)``: rows with a language and a text. The
    sample is drawn by a hash of the id, evenly over the languages (a language
    with few rows gives all of them); the rest of its bound, 2 KB a row, is fixed."""
    small_batches(docs.sparkSession)
    rows = docs.where("lang is not null and text is not null and text <> '' and id is not null")
    held = {r.lang: r.c for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("c")).collect()}
    if not held:
        return train([], [])
    # a share of the 2^62 values that the hash can take, so fine at any number of rows
    share = F.lit(0).cast("long")
    for lang, c in sorted(held.items()):
        share = F.when(F.col("lang") == lang, F.lit(min(1 << 62, (sample << 62) // (len(held) * c)))).otherwise(share)
    drawn = rows.where(F.shiftrightunsigned(F.xxhash64("id", F.lit(11)), 2) < share) \
        .select("lang", "id", "text").mapInArrow(_pack, "lang string, id long, bits binary").orderBy("id", "bits").collect()
    return train([r.lang for r in drawn], [bytes(r.bits) for r in drawn])


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    fold = F.crc32(F.col(id_col).cast("long").cast("string")) % 3 == 1
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).where(~fold)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``row`` (the input row), ``lang_pred`` and ``lang_score``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return add_columns(docs, text_col, "lang_pred string, lang_score double", lambda texts: sent.value.predict(texts))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    Learned from rows whose ``crc32(doc_id as text) mod 3`` is not 1. Texts
    that are null or hold no letter are ``und`` with score 0, as are all when
    there is nothing to learn from. Rows without an id are predicted, count as
    not held out and teach nothing; repeated rows stay. Texts are read whole.
    """
    model = fit(training_rows(docs, id_col, text_col, lang_col))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return predict(base, model).select(
        "row.doc_id", F.coalesce(F.crc32(F.col("row.doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"),
        "lang_pred", F.col("lang_score").alias("score"))


def op8_language_id(spark, sf_dir):
    """Predicted language of every document."""
    return identify(table(spark, sf_dir, "documents"))
