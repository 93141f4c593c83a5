"""Approximate nearest neighbours by cross-polytope hashing (operator 1).

A vector, scaled to length one, goes through three rounds of random signs and
a fast Hadamard transform (a pseudo-rotation) and is assigned to the nearest
signed axis. Each table has its own rotation; a stored vector lies in one
bucket of each table, a query probes the axes nearest to it. All vectors that
share a bucket with a probe are candidates and are reranked by the exact
inner product.

Vectors need not have length one. Stored vectors are split into bands of
length (``BAND`` from the longest down); inside a band the largest inner
product is nearly the nearest direction, so each is hashed by its direction
and every query probes every band. That needs no buckets of its own: a bucket
holds the vectors of one direction from all bands. Only a band of few vectors
(at most ``SCAN``) can have some of the largest products far from the query's
direction; such a band is not hashed but met by every query as a whole. So is
a small table. A query that still finds fewer than ``top`` rows meets all
stored vectors of its dimension.

Equal vectors are stored once. Only the ``top + 1`` smallest ids of a vector
can be in a result (ties go to the smaller id and a query drops only its own),
so a vector that very many rows share costs no more than any other.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rigcast.llm.common import stage, table

TABLES = 12
PROBES = 12          # nearest signed axes that a query probes in each table
BLOCK = 4000         # stored vectors of a bucket that meet the probes in one task
BAND = 1.1           # longest to shortest vector of a band of lengths
SCAN = 100           # stored vectors of a band up to which it is met as a whole; all larger bands are hashed
SEED = 7


def hadamard(x: np.ndarray) -> np.ndarray:
    """Normalised Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
    return x.reshape(n, d) / np.sqrt(d)


def rotations(dim: int, tables: int, seed: int) -> np.ndarray:
    """Signs of the three rounds of each table, over the padded width."""
    width = 1 << max(1, int(dim - 1).bit_length())
    return np.random.default_rng(seed).choice([-1.0, 1.0], size=(tables, 3, width))


def axes(x: np.ndarray, signs: np.ndarray, probes: int) -> np.ndarray:
    """For each row the ``probes`` nearest signed axes of one table, nearest first.
    Axis a is ``2 * a`` on its positive and ``2 * a + 1`` on its negative side."""
    y = np.zeros((len(x), signs.shape[1]))
    y[:, :x.shape[1]] = x
    for s in signs:
        y = hadamard(y * s)
    both = np.empty((len(x), 2 * y.shape[1]))
    both[:, 0::2], both[:, 1::2] = y, -y
    m = min(probes, both.shape[1])
    return np.argsort(-both, axis=1, kind="stable")[:, :m]


def _rows(b: pa.RecordBatch) -> np.ndarray:
    v = b.column("vec")
    return np.asarray(v.flatten(), np.float64).reshape(len(v), -1)


def _place(tables: int, probes: int, seed: int, query: bool):
    schema = pa.schema([("cls", pa.int64()), ("dim", pa.int32()), ("tab", pa.int32()), ("axis", pa.int32())])

    def run(batches):
        for b in batches:
            for dim in np.unique(b.column("dim").to_numpy()).tolist():
                part = b.filter(pa.array(b.column("dim").to_numpy() == dim))
                x = _rows(part)
                x = x / np.abs(x).max(axis=1)[:, None]       # squares neither overflow nor vanish
                x = x / np.sqrt((x * x).sum(axis=1))[:, None]
                cls = part.column("cls").to_numpy()
                for t, signs in enumerate(rotations(x.shape[1], tables, seed)):
                    a = axes(x, signs, probes if query else 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(cls, a.shape[1])), pa.array(np.full(a.size, dim, np.int32)),
                         pa.array(np.full(a.size, t, np.int32)), pa.array(a.ravel().astype(np.int32))], schema=schema)
    return run


_FOUND = pa.schema([("cls", pa.int64()), ("vec_ids", pa.list_(pa.int64())), ("lows", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])


def _best(low: np.ndarray, score: np.ndarray, keep: int) -> np.ndarray:
    """Places of the best ``keep``; of equal scores those with the smallest ids."""
    return np.lexsort((low, -score))[:keep]


def _filled(t: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    c = t.column(name).combine_chunks()
    return c.fill_null(0).to_numpy(zero_copy_only=False), c.is_valid().to_numpy(zero_copy_only=False)


def _score(keep: int, step: int = 256):
    """The best stored vectors of one bucket part for each probe that reaches it.
    ``low`` and ``second`` are the smallest ids of a stored class; a query that
    names its own id in ``low`` does not count classes which only that id has,
    and ranks one that it shares by the second id."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("cls")
        is_query = t.column("query").to_numpy()
        vec = t.column("vec").combine_chunks()
        x = np.asarray(vec.flatten(), np.float64).reshape(len(vec), -1)
        cls = t.column("cls").to_numpy()
        low, has_low = _filled(t, "low")
        second, has_second = _filled(t, "second")
        q, qc, own, names = x[is_query], cls[is_query], low[is_query], has_low[is_query]
        v, vc, low, second, alone = x[~is_query], cls[~is_query], low[~is_query], second[~is_query], ~has_second[~is_query]
        out = {"cls": [], "vec_ids": [], "lows": [], "scores": []}
        if len(q) and len(v):
            m = min(keep, len(v))
            # twice what a rough score can be off, so that all that tie with the last one kept are scored exactly
            slack = 4 * x.shape[1] * np.finfo(float).eps * np.linalg.norm(v, axis=1).max() * np.linalg.norm(q, axis=1)
            for i in range(0, len(q), step):
                rough = q[i:i + step] @ v.T
                mine = names[i:i + step, None] & (low == own[i:i + step, None])
                void = mine & alone
                rough[void] = -np.inf
                last = np.partition(rough, len(v) - m, axis=1)[:, len(v) - m] - slack[i:i + step]
                near = ~(rough < last[:, None]) & ~void
                for j in range(len(near)):
                    at = np.flatnonzero(near[j])
                    first = np.where(mine[j, at], second[at], low[at])
                    exact = (v[at] * q[i + j]).sum(axis=1)           # the same sum wherever the pair meets
                    best = _best(first, exact, keep)
                    out["cls"].append(int(qc[i + j]))
                    out["vec_ids"].append(vc[at[best]])
                    out["lows"].append(first[best])
                    out["scores"].append(exact[best])
        return pa.table({"cls": pa.array(out["cls"], pa.int64()), "vec_ids": pa.array(out["vec_ids"], pa.list_(pa.int64())),
                         "lows": pa.array(out["lows"], pa.list_(pa.int64())), "scores": pa.array(out["scores"], pa.list_(pa.float64()))}, schema=_FOUND)
    return run


def _merge(keep: int):
    schema = pa.schema([("cls", pa.int64()), ("near", pa.list_(pa.struct([("cls", pa.int64()), ("score", pa.float64())])))])

    def run(t: pa.Table) -> pa.Table:
        ids = np.asarray(t.column("vec_ids").combine_chunks().flatten(), np.int64)
        low = np.asarray(t.column("lows").combine_chunks().flatten(), np.int64)
        score = np.asarray(t.column("scores").combine_chunks().flatten(), np.float64)
        ids, first = np.unique(ids, return_index=True)
        low, score = low[first], score[first]
        best = _best(low, score, keep)
        return pa.table({"cls": [t.column("cls")[0].as_py()],
                         "near": [[{"cls": int(ids[i]), "score": float(score[i])} for i in best]]}, schema=schema)
    return run


def _in_blocks(stored: DataFrame, asked: DataFrame) -> DataFrame:
    """All of ``stored`` beside all of ``asked`` (``cls, dim, vec, low, second``) of the same
    ``dim``, dealt over pairs of blocks for ``_score``."""
    def parts(df: DataFrame, name: str) -> DataFrame:
        return F.broadcast(df.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("long").alias(name)))

    sizes = stage(parts(stored, "parts").join(parts(asked, "turns"), "dim"), "blocks")

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        return df.join(F.broadcast(sizes), "dim").select(
            "cls", "dim", "vec", "low", "second", F.pmod(F.xxhash64("cls"), F.col(own)).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other))

    both = dealt(stored, "parts", "turns").withColumn("query", F.lit(False)) \
        .unionByName(dealt(asked, "turns", "parts").withColumn("query", F.lit(True)))
    return both.groupBy("dim", "parts", "turns")


def _answers(near: DataFrame, classes: DataFrame, units: DataFrame, top: int) -> DataFrame:
    """From classes back to rows: top + 1 ids of each class found, then ``hits``
    of each query of ``units(id, cls)`` without its own id."""
    hits = near.select(F.col("cls").alias("wanted"), F.explode("near").alias("n")).select("wanted", F.col("n.cls").alias("cls"), F.col("n.score").alias("score")) \
        .join(classes.select("cls", "ids"), "cls").select("wanted", "score", F.explode("ids").alias("vec_id"))
    lists = hits.groupBy("wanted").agg(F.slice(F.array_sort(F.collect_set(F.struct((-F.col("score")).alias("minus"), "vec_id"))), 1, 2 * top + 2).alias("hits"))
    return units.join(lists, F.col("cls") == F.col("wanted"), "left").drop("wanted") \
        .withColumn("hits", F.coalesce(F.expr(f"slice(filter(hits, h -> h.vec_id <> id), 1, {top})"), F.expr("array()")))


def nearest(vectors: DataFrame, queries: DataFrame, top: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            tables: int = TABLES, probes: int = PROBES, seed: int = SEED) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``queries`` the
    ``top`` rows of ``vectors`` with the largest inner product that share a
    bucket with it or lie in a small band of length, the query's own id left
    out; ties go to the smaller id. Where these are fewer than ``top``, it is
    the ``top`` of all rows of the query's dimension, or all if there are fewer.

    Both frames hold ``id_col`` and ``vec_col``; extra columns are ignored.
    Null or zero vectors, vectors with null or non-finite components and rows
    without an id take no part. Vectors of another length are never compared.
    A repeated id in ``vectors`` counts once for each different vector it has;
    equal rows of ``queries`` give one result.
    """
    fine = F.expr(f"""{id_col} is not null and {vec_col} is not null and size({vec_col}) > 0
        and forall({vec_col}, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))
        and exists({vec_col}, x -> x <> 0)""")
    as_double = F.transform(F.col(vec_col), lambda x: x.cast("double") + F.lit(0.0))

    def clean(df: DataFrame) -> DataFrame:
        return df.where(fine).select(F.col(id_col).cast("long").alias("id"), as_double.alias("vec")).distinct()

    ranked = clean(vectors).withColumn("at", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("at") <= top + 1)
    # a class of equal vectors is named by its smallest id; an id with two vectors names two, so number them
    classes = stage(ranked.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
                    .withColumn("cls", F.monotonically_increasing_id()).withColumn("dim", F.size("vec"))
                    .withColumn("big", F.array_max(F.transform("vec", F.abs)))
                    .withColumn("log_length", F.expr("ln(big) + ln(aggregate(vec, 0D, (a, v) -> a + (v / big) * (v / big))) / 2")).drop("big"), "classes")
    asked = stage(clean(queries), "asked")
    wanted = stage(asked.select("vec").distinct().withColumn("cls", F.monotonically_increasing_id()).withColumn("dim", F.size("vec")), "wanted")
    longest = F.broadcast(classes.groupBy("dim").agg(F.max("log_length").alias("longest")))
    banded = classes.join(longest, "dim").withColumn("band", F.floor((F.col("longest") - F.col("log_length")) / math.log(BAND)))
    small = stage(banded.groupBy("dim", "band").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") <= SCAN), "small")
    hashed = banded.join(F.broadcast(small), ["dim", "band"], "left_anti")
    whole = banded.join(F.broadcast(small), ["dim", "band"], "left_semi")

    firsts = [F.col("ids")[0].alias("low"), F.get("ids", F.lit(1)).alias("second")]
    none = F.lit(None).cast("long")
    unnamed = [none.alias("low"), none.alias("second")]

    place = "cls long, dim int, tab int, axis int"
    stored = hashed.select("cls", "dim", "vec").mapInArrow(_place(tables, 1, seed, False), place)
    probed = wanted.select("cls", "dim", "vec").mapInArrow(_place(tables, probes, seed, True), place)
    stored = stage(stored, "stored")
    spread = stored.groupBy("dim", "tab", "axis").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("long").alias("parts"))
    bucket = ["dim", "tab", "axis"]
    left = stored.join(spread, bucket).withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts"))).drop("parts") \
        .join(classes.select("cls", "vec", *firsts), "cls").withColumn("query", F.lit(False))
    right = probed.join(spread, bucket).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts") \
        .join(wanted.select("cls", "vec", *unnamed), "cls").withColumn("query", F.lit(True))
    columns = "cls long, vec_ids array<long>, lows array<long>, scores array<double>"
    found = left.unionByName(right).groupBy(*bucket, "part").applyInArrow(_score(top + 1), columns) \
        .union(_in_blocks(whole.select("cls", "dim", "vec", *firsts), wanted.select("cls", "dim", "vec", *unnamed)).applyInArrow(_score(top + 1), columns))
    merged = "cls long, near array<struct<cls: long, score: double>>"
    near = found.groupBy("cls").applyInArrow(_merge(top + 1), merged)
    answers = stage(_answers(near, classes, asked.join(wanted, "vec").select("id", "cls"), top), "answers")
    result = answers.where(F.size("hits") >= top).select("id", "hits")
    # the few queries that found too little, each for its own id, against everything
    short = stage(answers.where(F.size("hits") < top).select("id", F.col("cls").alias("of")).join(wanted.withColumnRenamed("cls", "of"), "of")
                  .select("id", "dim", "vec", F.monotonically_increasing_id().alias("cls")), "short")
    if short.limit(1).count():
        all_near = _in_blocks(classes.select("cls", "dim", "vec", *firsts), short.select("cls", "dim", "vec", F.col("id").alias("low"), none.alias("second"))) \
            .applyInArrow(_score(top + 1), columns).groupBy("cls").applyInArrow(_merge(top + 1), merged)
        result = result.union(_answers(all_near, classes, short.select("id", "cls"), top).select("id", "hits"))
    return result.select(F.col("id").alias("query_id"), F.posexplode("hits").alias("pos", "h")) \
        .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("h.vec_id").alias("vec_id"), (-F.col("h.minus")).alias("score"))


def op1_cross_polytope(spark, sf_dir):
    """The 20 nearest rows of ``embeddings`` for every row whose id is divisible by 20."""
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 20 = 0"))
