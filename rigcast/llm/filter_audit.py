"""Filter interaction audit by the Hart-Mas-Colell potential (operator 13).

Five filters remove documents; what one of them removes depends on the filters
before it. The removal game gives every coalition S of filters the number
``v(S)`` of documents that fail at least one filter of S. Its potential
``P(S) = (v(S) + sum over i in S of P(S - i)) / |S|`` is computed recursively
over the 32 coalitions; the Shapley value of filter i is ``P(all) - P(all - i)``,
and a step of an order is the difference of two neighbouring coalitions.

Spark does everything that grows with the corpus: flags of every text, copies
found by an aggregation on the text's digest (a text that a third of the rows
share is one row per task before the shuffle), labels by a join on the id, and
counts per failure pattern. What reaches the game is one group of at most 128
rows per part.
"""

from __future__ import annotations

from itertools import permutations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rigcast.llm.common import table

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 100, 80, 10      # words; per cent of words; per cent of code points
SYMBOLS = "[#$%&*|]"
_GAP = "[\\x20\\x09-\\x0D]+"
LEDGER = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def text_flags(docs: DataFrame) -> DataFrame:
    """``doc_id, part, digest`` and the bits of filters A to D that each whole text fails."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    seen = base.select("doc_id", "part", "text", F.array_remove(F.split("text", _GAP), "").alias("words"))
    n = F.size("words")
    bits = [n < MIN_WORDS, 100 * F.size(F.array_distinct("words")) < MIN_DISTINCT * n,
            100 * F.length(F.regexp_replace("text", "[^A-Z]+", "")) > MAX_UPPER * F.length("text"), F.col("text").rlike(SYMBOLS)]
    fails = sum((F.when(b, 1 << i).otherwise(0) for i, b in enumerate(bits)), F.lit(0))
    return seen.select("doc_id", "part", F.md5("text").alias("digest"), fails.cast("int").alias("fails"))


def pattern_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, pattern, good, toxic, n``: documents per failure pattern (bit i: filter ``FILTERS[i]``) and label.

    A row fails filter E if a row with the same text has a smaller id; rows
    without an id neither fail it nor make others fail. Ids that repeat in
    ``labels`` count as good or toxic if any of their rows says so.
    """
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    who = ["digest", "part", "good", "toxic", "fails"]
    rows = text_flags(docs).join(marks, "doc_id", "left").fillna(False, ["good", "toxic"]) \
        .groupBy("doc_id", *who).agg(F.count(F.lit(1)).alias("n"))
    named = F.col("doc_id").isNotNull()
    alike = rows.groupBy(*who).agg(F.sum("n").alias("n"), F.sum(F.when(named, F.col("n")).otherwise(0)).alias("named"),
                                   F.min(F.when(named, F.struct("doc_id", "n"))).alias("first"))
    # rows of one text: one per part, label and so at most four times the number of parts
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    later = F.col("named") - F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    split = alike.withColumn("later", later).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("fails").alias("pattern"), (F.col("n") - F.col("later")).alias("n")),
            F.struct((F.col("fails") + 16).alias("pattern"), F.col("later").alias("n")))).alias("p"))
    return split.groupBy("part", F.col("p.pattern").alias("pattern"), "good", "toxic").agg(F.sum("p.n").alias("n"))


def removal_game(counts: list[int]) -> list[int]:
    """``v(S)`` of all 32 coalitions from the number of documents per failure pattern."""
    return [sum(c for p, c in enumerate(counts) if p & s) for s in range(ALL + 1)]


def potentials(v: list[int]) -> list[int]:
    """120 times the potential of every coalition, in whole numbers: with five
    players or fewer, every weight of a coalition's value is a multiple of 1/120."""
    out = [0] * len(v)
    for s in range(1, len(v)):                       # subsets of s are smaller numbers
        inner = sum(out[s ^ (1 << i)] for i in range(len(FILTERS)) if s >> i & 1)
        out[s] = (120 * v[s] + inner) // s.bit_count()
    return out


def ledger(part: str, counts: list[int], good: list[int], toxic: list[int]) -> pd.DataFrame:
    """The audit of one part: 120 orders of five steps."""
    v, vg, vt = removal_game(counts), removal_game(good), removal_game(toxic)
    pot, total = potentials(v), sum(counts)
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    rows = []
    for order in ORDERS:
        before = 0
        for step, f in enumerate(order, 1):
            after = before | bit[f]
            removed = v[after] - v[before]
            rows.append((part, order, step, total - v[after], removed, v[bit[f]] - removed, counts[bit[f]],
                         vg[after] - vg[before], vt[after] - vt[before], pot[ALL] - pot[ALL ^ bit[f]]))
            before = after
    return pd.DataFrame(rows, columns=[c.split()[0] for c in LEDGER.split(", ")])


def _audit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    def per_pattern(chosen: pd.DataFrame) -> list[int]:
        n = chosen.groupby("pattern").n.sum()
        return [int(n.get(p, 0)) for p in range(ALL + 1)]
    return ledger(key[0], per_pattern(rows), per_pattern(rows[rows.good]), per_pattern(rows[rows.toxic]))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step (``LEDGER``), zeros included.

    Null texts count as empty texts (they fail A), a null ``lang`` and the empty
    ``lang`` are one part, rows that repeat count each, an empty table has no
    part and so no rows. Texts are judged whole; extra columns are ignored;
    documents without a label are neither good nor toxic.
    """
    return pattern_counts(docs, labels).groupBy("part").applyInPandas(_audit, LEDGER)


def op13_filter_audit(spark, sf_dir):
    """Steps, unique failures and Shapley values of five filters in all 120 orders, per language."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH d AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM d),
f AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails
  FROM w),
l AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
             max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
p AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
x(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (
  SELECT a.c || b.c || g.c || h.c || i.c AS filter_order FROM x a, x b, x g, x h, x i
  WHERE a.c NOT IN (b.c, g.c, h.c, i.c) AND b.c NOT IN (g.c, h.c, i.c) AND g.c NOT IN (h.c, i.c) AND h.c <> i.c),
s AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter, fails, n, good, toxic,
         contains(fails, substr(filter_order, step, 1)) AS hit,
         length(translate(fails, substr(filter_order, 1, step - 1), '')) < length(fails) AS gone
  FROM p, o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
t AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM t
"""
