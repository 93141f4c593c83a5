"""Quality classifier: naive Bayes support vectors (operator 3).

Texts become indicators of hashed n-grams (bytes, words, pairs of words, and
repetition marks). Class log-count ratios over all labelled training texts
scale the indicators; a linear hinge-loss model is then fitted on the scaled
rows by dual coordinate descent. The ratios count every training row; only
the fit uses a sample of at most about ``SAMPLE`` rows, drawn by a hash of the
id. Margins become probabilities by a logistic fit on rows left out of the fit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigcast.llm.common import add_columns, id_bits, id_hits, id_place, small_batches, stage, table
from rigcast.llm.ngrams import byte_grams, presence, word_grams
from rigcast.llm.textnum import Flat, chunks

WIDTH = 1 << 16      # hashed features
SAMPLE = 8000        # expected rows of the fit and its calibration, at most
ALPHA = 1.0          # smoothing of the counts
COST = 1.0           # C of the hinge loss
EPOCHS = 10
THRESHOLD = 0.7


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    flat = Flat(texts)
    return presence(flat, [byte_grams(flat, 1, WIDTH), byte_grams(flat, 3, WIDTH), *word_grams(flat, WIDTH)], WIDTH)


@dataclass
class Model:
    weight: np.ndarray        # of an indicator, ratio included
    square: np.ndarray        # squared ratio: the length of a scaled row
    bias: float
    slope: float
    shift: float

    def score(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        def sums(x):
            return np.diff(np.r_[0.0, np.cumsum(x)][first])
        margin = sums(self.weight[ids]) / np.sqrt(np.maximum(sums(self.square[ids]), 1e-12)) + self.bias
        return 1 / (1 + np.exp(np.clip(-(self.slope * margin + self.shift), -500, 500)))


def pack(ids: np.ndarray, first: np.ndarray) -> list[bytes]:
    """The ascending features of each text as gaps, seven bits to a byte, the top bit set on all but a gap's last byte."""
    gap = np.diff(ids, prepend=0)
    start = first[:-1][np.diff(first) > 0]
    gap[start] = ids[start]
    size = 1 + (gap >= 1 << 7) + (gap >= 1 << 14)
    end = np.r_[0, np.cumsum(size)]
    out = np.zeros(end[-1], np.uint8)
    for k in range(3):                              # byte k from the end of its gap
        on = size > k
        out[end[1:][on] - 1 - k] = (gap[on] >> 7 * k & 127) | (128 if k else 0)
    raw, cut = out.tobytes(), end[first].tolist()
    return [raw[a:b] for a, b in zip(cut, cut[1:])]


def unpack(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8)
    last = np.flatnonzero(b < 128)
    size = np.diff(last, prepend=-1)
    gap = b[last].astype(np.int64)
    for k in (1, 2):
        on = size > k
        gap[on] += (b[last[on] - k].astype(np.int64) & 127) << 7 * k
    return np.cumsum(gap)


def log_ratio(pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    p, q = ALPHA + pos, ALPHA + neg
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = COST, epochs: int = EPOCHS,
                 seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights over scaled unit rows and the bias of a linear hinge-loss model (L2 regularised, bias included)."""
    norm = np.array([max(np.sqrt((ratio[r]**2).sum()), 1e-6) for r in rows])
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    share = max(1.0, (y > 0).sum()) / max(1.0, (y < 0).sum())
    top = np.where(y > 0, cost, cost * min(share, 10.0))           # the rarer class weighs more
    q = np.array([((ratio[r] / n)**2).sum() for r, n in zip(rows, norm)]) + 1.0
    order, rng = np.arange(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        for i in order.tolist():
            x = ratio[rows[i]] / norm[i]
            g = y[i] * (w[rows[i]] @ x + bias) - 1
            new = min(max(alpha[i] - g / q[i], 0.0), top[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step * x
                bias += step
                alpha[i] = new
    return w, bias


def logistic(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of P(good | margin), with smoothed targets; the slope stays positive."""
    up, down = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 3.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(-(a * margin + b), -500, 500)))
        d, g = np.maximum(p * (1 - p), 1e-9), p - t
        h = np.array([[(d * margin**2).sum() + 1e-3, (d * margin).sum()], [(d * margin).sum(), d.sum() + 1e-3]])
        step = np.linalg.solve(h, [(g * margin).sum(), g.sum()])
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 1e-3), float(b)


def _featurise(bits):
    schema = pa.schema([("id", pa.int64()), ("feats", pa.binary())])

    def run(batches):
        for b in batches:
            for c in chunks([b.filter(pa.array(id_hits(bits.value, b.column("at").to_numpy())))], "text", 1 << 20):
                yield pa.RecordBatch.from_arrays([c.column("id"), pa.array(pack(*features(c.column("text").to_pylist())), pa.binary())],
                                                 schema=schema)
    return run


def _count(batches):
    schema = pa.schema([("part", pa.int32()), ("pos", pa.binary()), ("neg", pa.binary())])
    total = np.zeros((2, WIDTH), np.int64)
    for b in batches:
        for y, raw in zip(b.column("quality").to_pylist(), b.column("feats").to_pylist()):
            total[int(y), unpack(raw)] += 1
    step = WIDTH // 16
    for i in range(16):
        cut = total[:, i * step:(i + 1) * step]
        yield pa.RecordBatch.from_pydict({"part": [i], "pos": [cut[1].tobytes()], "neg": [cut[0].tobytes()]}, schema=schema)


def _add_counts(t: pa.Table) -> pa.Table:
    def total(name):
        return sum(np.frombuffer(x, np.int64) for x in t.column(name).to_pylist()).tobytes()
    return pa.table({"part": [t.column("part")[0].as_py()], "pos": [total("pos")], "neg": [total("neg")]},
                    schema=pa.schema([("part", pa.int32()), ("pos", pa.binary()), ("neg", pa.binary())]))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from ``docs(id, text)`` and ``labels(id, quality)``; rows whose
    quality is not 0 or 1 are left out. With fewer than two classes the score
    is the share of good rows (one half without any)."""
    spark = docs.sparkSession
    small_batches(spark)
    labels = labels.where("id is not null and quality in (0, 1)").groupBy("id").agg(F.max("quality").cast("int").alias("quality"))
    bits = spark.sparkContext.broadcast(id_bits(labels))
    rows = docs.where("id is not null").select("id", "text", id_place("id")).mapInArrow(_featurise(bits), "id long, feats binary") \
        .join(labels.hint("shuffle_hash"), "id")    # one plan at every size: labels grow with the documents
    rows = stage(rows, "feats")
    n = rows.count()
    width = "part int, pos binary, neg binary"
    counts = rows.select("quality", "feats").mapInArrow(_count, width).groupBy("part").applyInArrow(_add_counts, width) \
        .orderBy("part").collect()
    if not counts:
        return Model(np.zeros(WIDTH), np.zeros(WIDTH), 0.0, 1.0, 0.0)
    pos = np.concatenate([np.frombuffer(r.pos, np.int64) for r in counts])
    neg = np.concatenate([np.frombuffer(r.neg, np.int64) for r in counts])
    ratio = log_ratio(pos, neg)
    share = min(1 << 62, (sample << 62) // max(n, 1))        # of the 2^62 values of the hash: fine at any number of rows
    drawn = rows.where(F.shiftrightunsigned(F.xxhash64("id", F.lit(3)), 2) < F.lit(share)).orderBy("id", "feats").collect()
    x = [unpack(r.feats) for r in drawn]
    y = np.array([1.0 if r.quality else -1.0 for r in drawn])
    if not len(y) or abs(y.sum()) == len(y):
        good = (y > 0).mean() if len(y) else 0.5
        return Model(np.zeros(WIDTH), np.zeros(WIDTH), 0.0, 1.0, float(np.log((good * len(y) + 1) / ((1 - good) * len(y) + 1))))
    held = np.arange(len(y)) % 4 == 3
    if abs(y[held].sum()) == held.sum() or abs(y[~held].sum()) == (~held).sum():
        held = np.zeros(len(y), bool)
    w, bias = dual_descent([r for r, h in zip(x, held) if not h], y[~held], ratio)
    model = Model(w * ratio, ratio**2, bias, 1.0, 0.0)
    on = held if held.any() else ~held
    margin = []
    for r, h in zip(x, on):
        if h:
            margin.append(model.weight[r].sum() / np.sqrt(max(model.square[r].sum(), 1e-12)) + bias)
    model.slope, model.shift = logistic(np.array(margin), y[on])
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``row`` (the input row) and its ``score`` from 0 to 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return add_columns(docs, text_col, "score double", lambda texts: {"score": sent.value.score(*features(texts))})


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Held out are rows whose ``crc32(doc_id as text) mod 4`` is 2: their labels
    are not read. Null and empty texts have no features and get the score of
    the bias; rows without an id are scored and count as not held out, but
    teach nothing. Repeated rows stay. Extra columns are ignored.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    fold = F.coalesce(F.crc32(F.col("id").cast("string")) % 4 == 2, F.lit(False))
    known = labels.select(F.col(id_col).cast("long").alias("id"), "quality").where(~fold)
    model = fit(base.where(~fold), known)
    out = score(base, model).select("row.id", "score")
    return out.select(F.col("id").alias("doc_id"), fold.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op3_nb_svm(spark, sf_dir):
    """Quality score of every document, learned from the labels outside the held-out fold."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
