"""C: ordered splits and fold assignment on a dense index.

Borders are computed on the driver with the same Python float expression the
batch pipeline uses (``int(n * frac)`` truncates), then applied as range
filters on ``idx``; when the indexed table is stored sorted by ``idx`` the
filters prune row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigcast.operators.order import IndexedTable


def _part(df, lo: int, hi: int, idx: str) -> DataFrame:
    """Rows with ``lo <= idx < hi``: pushed into the scan for an IndexedTable."""
    if isinstance(df, IndexedTable):
        return df.between(lo, hi)
    return df.where((F.col(idx) >= lo) & (F.col(idx) < hi))


def split_border(n: int, frac: float) -> int:
    return int(n * frac)


def prefix_split(df: DataFrame, n: int, train_size: float, idx: str = "idx") -> tuple[DataFrame, DataFrame]:
    """Train ``[0, k)``, test ``[k, n)`` with ``k = int(n * train_size)``."""
    k = split_border(n, train_size)
    return _part(df, 0, k, idx), _part(df, k, n, idx)


def inclusive_split(df: DataFrame, n: int, train_size: float, idx: str = "idx") -> tuple[DataFrame, DataFrame]:
    """Label-inclusive prefix split; row ``k`` is in both parts."""
    k = split_border(n, train_size)
    return _part(df, 0, k + 1, idx), _part(df, k, n, idx)


def three_way_borders(n: int, val_split: float, test_split: float) -> dict[str, tuple[int, int]]:
    b1 = int(n * (1 - val_split - test_split))
    b2 = int(n * (1 - test_split))
    return {"train": (0, b1), "val": (b1, b2), "test": (b2, n)}


def three_way_split(df: DataFrame, n: int, val_split: float, test_split: float,
                    idx: str = "idx") -> dict[str, DataFrame]:
    """train/val/test with inclusive borders (``.loc[b1:b2]``): the row at
    each inner border belongs to both neighbouring parts."""
    return {part: _part(df, lo, hi + 1, idx)
            for part, (lo, hi) in three_way_borders(n, val_split, test_split).items()}


def fold_bounds(n: int, k: int) -> list[tuple[int, int, int]]:
    """C4: expanding-window folds ``(fold, val_start, val_end)``; fold ``j``
    trains on ``[0, val_start)``. ``size = n // (k + 1)``."""
    if k < 2:
        raise ValueError("at least two folds are needed")
    size = n // (k + 1)
    if size < 1:
        raise ValueError(f"{n} rows cannot be cut into {k} folds")
    first = n - k * size
    return [(j + 1, first + j * size, first + (j + 1) * size) for j in range(k)]


def fold_table(spark: SparkSession, n: int, k: int) -> DataFrame:
    return spark.createDataFrame(fold_bounds(n, k), "fold int, val_start long, val_end long")


def assign_folds(df: DataFrame, n: int, k: int, idx: str = "idx") -> DataFrame:
    """C4: every row gets one output row per fold it belongs to, with
    ``role`` = ``train`` or ``val``. The k-row bounds table is broadcast and
    joined with a range condition (no shuffle of the data)."""
    bounds = F.broadcast(fold_table(df.sparkSession, n, k))
    joined = df.join(bounds, F.col(idx) < F.col("val_end"))
    return joined.withColumn(
        "role", F.when(F.col(idx) >= F.col("val_start"), F.lit("val")).otherwise(F.lit("train")))


def holdout_tail(df: DataFrame, m: int, val_size: float, pos: str = "window_no") -> tuple[DataFrame, DataFrame]:
    """The last ``val_size`` share of ``m`` samples, cut at
    ``floor(m * (1 - val_size))``, without shuffling."""
    cut = int(m * (1 - val_size))
    return df.where(F.col(pos) < cut), df.where(F.col(pos) >= cut)


def seeded_repeats(spark: SparkSession, exps: int, seed: int = 0) -> DataFrame:
    """One row per repeat with its seed: ``seed += ii`` for ii in 0..exps-1."""
    rows, s = [], seed
    for ii in range(exps):
        s += ii
        rows.append((ii, s))
    return spark.createDataFrame(rows, "exp int, seed long")
