"""Weak supervision by quality rules (operator 2).

Every rule looks at one figure of the text and votes good, votes bad or
abstains. Expectation-maximisation over the counts of vote patterns estimates
each rule's accuracy on good and on bad texts and the share of good ones; the
posterior probability of "good" replaces an all-must-pass filter. There are at
most ``3 ** len(RULES)`` patterns, so the table on which EM runs, and the
posteriors that are joined back, are bounded at any size of corpus.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigcast.llm.common import add_columns, stage, table
from rigcast.llm.wordstats import text_stats

GOOD, BAD, NONE = "1", "0", "-"
KEEP = 0.5           # least posterior probability of a kept text
ROUNDS = 50
PRIOR = (8.0, 2.0)   # pseudo-counts of a rule's right and wrong votes; keeps "good" the class that good votes point to
BASE_WORDS, BASE_REPEAT = 10, 20

# name: (figure, good from, good to, bad below, bad above, least words that it needs)
RULES = {
    "symbols": ("symbols", 0.0, 0.05, -1.0, 0.2, 10),
    "letters": ("letters", 0.90, 1.01, 0.75, 2.0, 30),
    "repeats": ("repeats", 0.0, 0.15, -1.0, 0.5, 10),
    "dup_lines": ("dup_lines", 0.0, 0.25, -1.0, 0.6, 30),
    "top_word": ("top_word", 0.0, 0.15, -1.0, 0.25, 20),
    "adjacent": ("adjacent", 0.0, 0.03, -1.0, 0.1, 20),
    "distinct": ("distinct", 0.45, 1.01, 0.25, 2.0, 30),
    "sentences": ("sentences", 0.03, 0.3, 0.005, 0.6, 60),
    "word_length": ("word_length", 3.5, 6.8, 2.5, 12.0, 10),
}
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def votes(stats: dict[str, np.ndarray]) -> list[str]:
    """One character per rule for each text."""
    n = np.maximum(stats["n_words"], 1)
    chars = np.maximum(stats["word_chars"], 1)
    figure = {"symbols": stats["n_symbols"] / n, "letters": stats["n_letters"] / chars, "repeats": stats["n_repeat_words"] / n,
              "dup_lines": stats["n_dup_lines"] / np.maximum(stats["n_lines"], 1), "top_word": stats["top_word"] / n,
              "adjacent": stats["n_adjacent"] / n, "distinct": stats["n_distinct"] / n, "sentences": stats["n_stop_ends"] / n,
              "word_length": stats["word_chars"] / n}
    # a vocabulary grows slower than its text: long texts are judged by the share expected of 1,000 words
    figure["distinct"] = figure["distinct"] * np.maximum(1.0, n / 1000) ** 0.3
    out = []
    for name, lo, hi, below, above, least in RULES.values():
        x = figure[name]
        vote = np.where((x < below) | (x > above), BAD, np.where((x >= lo) & (x <= hi), GOOD, NONE))
        out.append(np.where(stats["n_words"] >= least, vote, NONE))
    return ["".join(v) for v in zip(*out)] if len(n) else []


def _work(texts):
    s = text_stats(texts)
    return {c: s[c] for c in STATS} | {"votes": votes(s)}


def rule_votes(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (the input row) with the base figures and the rules' votes."""
    out = add_columns(docs, text_col, ", ".join(f"{c} long" for c in STATS) + ", votes string", _work)
    return out.withColumn("base_failed", F.expr(f"n_words < {BASE_WORDS} or 100 * n_repeat_words > {BASE_REPEAT} * n_words"))


def fit_em(patterns: list[str], counts: list[int]) -> tuple[np.ndarray, dict]:
    """Posterior of "good" for each vote pattern, and the estimated model."""
    m = len(RULES)
    if not patterns:
        return np.empty(0), {"good": 0.5, "right": np.full((2, m), 0.8)}
    v = np.array([[{GOOD: 1, BAD: 0, NONE: -1}[c] for c in p] for p in patterns])
    w = np.array(counts, float)
    up, down = (v == 1), (v == 0)
    share = (up.sum(1) + 1.0) / (up.sum(1) + down.sum(1) + 2.0)
    post = np.where(down.sum(1) >= 2, np.minimum(share, 0.4), share)
    right, good = np.empty((2, m)), 0.5
    for _ in range(ROUNDS):
        for c, p in ((0, 1 - post), (1, post)):
            hit, miss = ((up, down) if c else (down, up))
            a, b = (w * p) @ hit + PRIOR[0], (w * p) @ miss + PRIOR[1]
            right[c] = a / (a + b)
        good = float(((w * post).sum() + 1) / (w.sum() + 2))
        like = np.log([[1 - good], [good]]) + np.array([
            down @ np.log(right[0]) + up @ np.log(1 - right[0]),
            up @ np.log(right[1]) + down @ np.log(1 - right[1])])
        post = 1 / (1 + np.exp(np.clip(like[0] - like[1], -700, 700)))
    return post, {"good": good, "right": right}


def posteriors(voted: DataFrame) -> DataFrame:
    """``(votes, quality)``: at most 3 to the number of rules rows."""
    rows = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("c")).orderBy("votes").collect()
    post, _ = fit_em([r.votes for r in rows], [r.c for r in rows])
    return voted.sparkSession.createDataFrame([(r.votes, float(p)) for r, p in zip(rows, post)], "votes string, quality double")


def judge(voted: DataFrame, model: DataFrame) -> DataFrame:
    """Adds ``quality`` and ``kept``; the model has a bounded number of rows, so it is broadcast."""
    return voted.join(F.broadcast(model), "votes").withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the base figures, ``base_failed``, ``kept`` and the posterior ``quality`` of every row.

    Null and empty texts have no words and fail the base rule; their rules
    abstain. Null ids and repeated rows are kept as they are; an empty table
    gives no rows. Texts are read whole, and EM counts every row.
    """
    voted = rule_votes(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "text")
    voted = stage(voted.select("row.doc_id", *STATS, "votes", "base_failed"), "votes")
    return judge(voted, posteriors(voted)).select("doc_id", *STATS, "base_failed", "kept", "quality")


def op2_quality_rules(spark, sf_dir):
    """Base figures and weak-supervision verdict of every document."""
    return quality(table(spark, sf_dir, "documents"))
