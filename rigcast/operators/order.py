"""Dense row index over a total order, without a single-task window.

Phase 1 range-partitions the rows on the order keys, sorts inside each
partition and stamps every row with ``monotonically_increasing_id`` (partition
number in the upper bits, position in the lower 33). The stamped rows are
written once under the checkpoint folder, so range sampling and the stamp are
never recomputed. Phase 2 counts rows per partition (one row per partition,
collected), turns the counts into offsets and joins them back with a
broadcast whose size is bounded by the partition count.
``idx = offset + position`` is 0..n-1.

Because the stamps grow with ``idx`` and are stored in that order, an
``idx`` range is an exact ``_rid`` range: :class:`IndexedTable` pushes split
borders into the Parquet scan.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigcast.session import materialize

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _sort_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


@dataclass
class IndexedTable:
    """Stored rows with their stamp ``_rid`` plus the per-partition offsets.

    ``frame()`` is the indexed DataFrame. ``between(lo, hi)`` returns the rows
    with ``lo <= idx < hi`` through an equivalent ``_rid`` range: the stamps
    grow with ``idx`` and are stored in that order, so the range reaches the
    Parquet scan as pushed filters and skips files and row groups."""
    stored: DataFrame
    offsets: list = field(repr=False)       # sorted (pid, offset, count), one per partition
    idx: str = "idx"

    @property
    def count(self) -> int:
        return sum(c for _, _, c in self.offsets)

    def frame(self, rows: DataFrame | None = None) -> DataFrame:
        src = self.stored if rows is None else rows
        spark = src.sparkSession
        off = spark.createDataFrame([(p, o) for p, o, _ in self.offsets], "_pid long, _off long")
        pid = F.shiftright(F.col("_rid"), _POS_BITS)
        body = [c for c in src.columns if c != "_rid"]
        joined = src.join(F.broadcast(off), pid == F.col("_pid"))
        return joined.select(*[F.col(f"`{c}`") for c in body],
                             (F.col("_off") + F.col("_rid").bitwiseAND(F.lit(_POS_MASK))).alias(self.idx))

    def _rid_of(self, i: int) -> int:
        starts = [o for _, o, _ in self.offsets]
        k = bisect_right(starts, i) - 1
        pid, off, _ = self.offsets[k]
        return (pid << _POS_BITS) + (i - off)

    def between(self, lo: int, hi: int) -> DataFrame:
        return self.ranges([(lo, hi)])

    def ranges(self, parts: Sequence[tuple[int, int]]) -> DataFrame:
        """Rows of any of the ranges ``[lo, hi)``, each as a range of stamps."""
        parts = [(max(lo, 0), min(hi, self.count)) for lo, hi in parts]
        terms = [F.col("_rid").between(self._rid_of(lo), self._rid_of(hi - 1)) for lo, hi in merged(parts)]
        return self.frame(self.stored.where(any_of(terms)))

    def view(self, shape: Callable[[DataFrame], DataFrame]) -> IndexedView:
        """The table with a projection that every reading applies."""
        return IndexedView(self, shape)


@dataclass
class IndexedView:
    """An :class:`IndexedTable` behind a row-wise projection that keeps ``idx``:
    index ranges still reach the scan as ranges of stamps."""
    table: IndexedTable
    shape: Callable[[DataFrame], DataFrame] = field(repr=False)

    @property
    def count(self) -> int:
        return self.table.count

    def frame(self) -> DataFrame:
        return self.shape(self.table.frame())

    def between(self, lo: int, hi: int) -> DataFrame:
        return self.shape(self.table.between(lo, hi))

    def ranges(self, parts: Sequence[tuple[int, int]]) -> DataFrame:
        return self.shape(self.table.ranges(parts))

    def view(self, shape: Callable[[DataFrame], DataFrame]) -> IndexedView:
        return IndexedView(self.table, lambda df: shape(self.shape(df)))


def merged(parts: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges ``[lo, hi)`` in order, empty ones left out, overlapping and touching ones joined."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(p for p in parts if p[1] > p[0]):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def any_of(terms: Sequence[Column]) -> Column:
    out = F.lit(False)
    for i, t in enumerate(terms):
        out = t if i == 0 else out | t
    return out


def rows_in(src: DataFrame | IndexedTable | IndexedView, parts: Sequence[tuple[int, int]], idx: str = "idx") -> DataFrame:
    """Rows whose index is in any of the ranges ``[lo, hi)``; pushed into the scan of a stored index."""
    if isinstance(src, DataFrame):
        return src.where(any_of([(F.col(idx) >= lo) & (F.col(idx) < hi) for lo, hi in merged(parts)]))
    return src.ranges(parts)


def index_table(df: DataFrame, order: Sequence[str | Column], idx: str = "idx",
                num_partitions: int | None = None, name: str = "dense-index",
                reuse_input: bool = True) -> IndexedTable:
    """Phase 1 of the dense index (one write) and the per-partition offsets
    (one tiny aggregate, collected: one row per partition).

    Range partitioning runs its input twice (key sampling, then the shuffle
    write). ``reuse_input`` persists the input (memory, spilling to disk)
    for the duration of phase 1, so the source is scanned and parsed once;
    lost blocks are recomputed from lineage, and the cache is released as
    soon as the stamped rows are stored."""
    spark = df.sparkSession
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _sort_cols(order)
    reuse_input = reuse_input and not df.is_cached      # never drop the caller's cache
    src = df.persist(StorageLevel.MEMORY_AND_DISK) if reuse_input else df
    try:
        stamped = (src.repartitionByRange(parts, *keys)
                   .sortWithinPartitions(*keys)
                   .withColumn("_rid", F.monotonically_increasing_id()))
        stored = materialize(stamped, name)
    finally:
        if reuse_input:
            src.unpersist()
    counts = (stored.groupBy(F.shiftright(F.col("_rid"), _POS_BITS).alias("_pid"))
              .agg(F.count(F.lit(1)).alias("_n"), F.max(F.col("_rid").bitwiseAND(F.lit(_POS_MASK))).alias("_last")).orderBy("_pid").collect())
    offsets, run = [], 0
    for r in counts:
        if r["_last"] + 1 != r["_n"]:
            raise ValueError(f"a partition holds more than 2^{_POS_BITS} rows; use more partitions")
        offsets.append((int(r["_pid"]), run, int(r["_n"])))
        run += int(r["_n"])
    return IndexedTable(stored, offsets, idx)


def dense_index(df: DataFrame, order: Sequence[str | Column], idx: str = "idx",
                num_partitions: int | None = None, name: str = "dense-index") -> DataFrame:
    """Add ``idx`` = 0..n-1 following ``order`` (ties must be broken by the
    caller: give a total order). Runs one write job and one tiny count job
    (documented actions)."""
    return index_table(df, order, idx, num_partitions, name).frame()


#: Total order of the raw union; the tie-breakers keep the line order within a file
RAW_ORDER = ("UNIT", "TEST", "_file", "_block", "_ord")


def shaped(src: DataFrame | IndexedTable | IndexedView, shape: Callable[[DataFrame], DataFrame]):
    """``shape`` applied now to a DataFrame, or on every reading of a stored index."""
    return shape(src) if isinstance(src, DataFrame) else src.view(shape)
