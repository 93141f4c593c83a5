"""Reading tables, staging intermediate results, connected components."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rigcast.session import scratch_path

FILTER_BITS = 1 << 23  # fixed size of an id filter
ARROW_ROWS = 500      # rows per Arrow batch: bounds a Python worker's memory on long texts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that whole texts of any length fit a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: cuts the
    lineage, and a lost executor costs a reread instead of a recomputation. The
    shuffle files of the write go with its end, not when the driver next collects garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_bits(ids: DataFrame) -> np.ndarray:
    """A bitmap of ``FILTER_BITS`` bits over the hashed ``id`` column. Its size
    is fixed, so it is collected and sent to the tasks at any size of input;
    callers remove false hits by a join, and a full bitmap only saves less."""
    words = ids.select(id_place("id")).groupBy(F.expr("at div 64").cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def id_place(col: str):
    return F.pmod(F.xxhash64(col), F.lit(FILTER_BITS)).alias("at")


def id_hits(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def add_columns(docs: DataFrame, text_col: str, columns: str, work: Callable) -> DataFrame:
    """``row`` (the whole input row as a struct, so that no name clashes) and
    the ``columns`` that ``work(texts) -> dict of arrays`` derives from its text."""
    from rigcast.llm.textnum import chunks
    spark = docs.sparkSession
    small_batches(spark)
    extra = StructType.fromDDL(columns)
    schema = StructType([StructField("row", docs.schema), *extra.fields])

    def run(batches):
        for b in chunks(batches, "text", 1 << 20):
            got = work(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("row"), *[pa.array(got[f.name]) for f in extra.fields]],
                                             names=["row", *[f.name for f in extra.fields]])

    return docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of undirected ``links(a, b)`` as ``(node, comp)``,
    ``comp`` being the smallest node of the component.

    Alternating large-star and small-star rounds over the edge list; each
    round is one aggregation and one join on the node, is written to the
    shared scratch folder, and the rounds end when the edges stop changing
    (about log of the longest path). Nodes without a link do not appear.
    """
    edges = stage(links.select("a", "b").where("a <> b").distinct(), name)

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not large:
            both = both.where("b < a")
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        out = both.join(low, "a")
        far = out.where("b > a") if large else out
        moved = far.select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            moved = moved.union(low.select("a", F.col("m").alias("b")))
        return moved.where("a <> b").distinct()

    def print_of(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = None
    while True:
        edges = stage(star(star(edges, True), False), name)
        now = print_of(edges)
        if before is not None and now == before or now[0] == 0:
            break
        before = now
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(own)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the jobs run inside; the caller's comes back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def text_batches(spark: SparkSession, rows: int = ARROW_ROWS):
    """Small Arrow batches for the jobs run inside; the caller's setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


HOT_SHARE = 1000      # a key with more than this fraction of all rows is hot: there are fewer than HOT_SHARE such keys


def hot_join(rows: DataFrame, keyed: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Inner join of stored ``rows`` with ``keyed`` (one row per ``key``, ``count`` rows each
    of ``total``). Hot keys, fewer than ``HOT_SHARE`` by the definition, are joined by a
    broadcast and so stay where their rows lie; all others are shuffled."""
    hot = F.col(count) * HOT_SHARE > total
    warm = F.broadcast(keyed.where(hot).drop(count))
    cold = rows.join(warm.select(key), key, "left_anti").join(keyed.where(~hot).drop(count), key)
    return rows.join(warm, key).unionByName(cold)
