"""F: lag models fitted from shifted range sums, all on the executors.

A model regresses ``y[a + h - 1]`` on the values of one or more series at the
lags ``a - 1 .. a - L`` (plus an intercept). Every entry of its normal equations
over an anchor range ``[s, e)`` is a difference of running sums of lagged
products ``x_i[t] * x_j[t + d]``, shifted by at most the lookback. So:

1. One pass over the rows. Halo blocks (bounded size) are reduced with numpy to
   sums per segment between *cut points* (the borders of all requested ranges):
   ``d = 0 .. D`` lagged products of the wanted pairs of series, the sums of the
   series and the row count; a partial and a final ``sum`` add them up.
2. Running sums over the segments: a window per pair and lag, whose rows are as
   many as there are cuts.
3. The rows next to the cuts (some lookbacks each), read as index ranges.
4. Sums and rows meet per (unit, job) in a cogroup, where the Gram matrix is put
   together and solved. A unit is one series (autoregression) or all of them
   (vector autoregression); a job is one fit with its ranges. Statistics never
   reach the driver; group sizes depend on the configuration alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rigcast.operators.clean import col
from rigcast.operators.order import rows_in
from rigcast.operators.windows import halo_blocks
from rigcast.session import materialize

BLOCK = 1 << 16       # most rows of a statistics block
BLOCKS = 64           # a short series is still cut into about so many blocks
SUM_X, COUNT = -1, -2                                   # values of d besides the lags
SUMS_SCHEMA = "unit int, i int, j int, seg int, d int, s double"
SOLVED_SCHEMA = ("unit int, job string, out int, h int, lookback int, ridge double, n long, intercept double, coef array<double>, "
                 "scores array<struct<range:string,n:long,mse:double>>, gap string")


@dataclass(frozen=True)
class Job:
    """One fit: anchors ``fit``, ranges to score, ridge values (a grid is resolved on ``evals[select_on]``)."""
    name: str
    lookback: int
    fit: tuple[int, int]
    evals: dict = field(default_factory=dict)
    ridge: tuple = (1e-3,)
    select_on: str = "tail"
    horizon: int = 1

    def ranges(self) -> list[tuple[int, int]]:
        return [self.fit, *self.evals.values()]

    def cuts(self) -> list[int]:
        return sorted({c for r in self.ranges() for c in r})

    def near(self) -> list[tuple[int, int]]:
        """Row ranges next to the cuts that the shifted sums touch."""
        return [(c - self.lookback - 2, c + self.lookback + 2 * self.horizon + 2) for c in self.cuts()]


def stats_block(n_rows: int, max_lag: int) -> int:
    """Rows per statistics block: bounded, and with a halo of at most a twentieth."""
    return max(20 * (max_lag + 1), min(BLOCK, -(-n_rows // BLOCKS)))


def lag_sums(src, names: Sequence[str], max_lag: int, cuts: Sequence[int], block: int, cross: bool, idx: str = "idx") -> DataFrame:
    """Sums per ``(unit, i, j, seg, d)`` over rows ``t`` with ``cuts[seg - 1] <= t < cuts[seg]``:
    ``x_i[t] * x_j[t + d]``, for ``d = SUM_X`` ``x_i[t]`` and for ``d = COUNT`` the rows.
    ``cross``: all pairs of ``names`` in unit 0; else each name with itself in a unit of its own.
    Segments without rows are present with zeros. Lazy."""
    at = np.array(cuts, np.int64)
    k = len(names)
    rows = rows_in(src, [(0, int(at[-1]) + max_lag)], idx)
    blocks, _ = halo_blocks(rows.select(F.col(idx).alias("_i"), F.array(*[col(c).cast("double") for c in names]).alias("x")), 0, max_lag, block, "_i")
    which = (np.arange(k), np.arange(k)) if not cross else tuple(a.ravel() for a in np.indices((k, k)))
    unit = np.zeros(k * k, int) if cross else np.arange(k)
    name_i, name_j = which if cross else (np.zeros(k, int), np.zeros(k, int))

    def reduce_block(pdf: pd.DataFrame) -> pd.DataFrame:
        base = int(pdf["_blk"].iloc[0]) * block
        pos = pdf["_i"].to_numpy(np.int64) - base
        x = np.zeros((block + max_lag, k))
        have = np.zeros(block + max_lag, bool)
        x[pos] = np.vstack(pdf["x"].to_numpy())
        have[pos] = True
        seg = np.searchsorted(at, base + np.arange(block), side="right")
        used, first = np.unique(seg, return_index=True)
        first, used = first[used < len(at)], used[used < len(at)]
        stop = int(np.searchsorted(seg, len(at)))
        if not len(used) or not have[:stop].any():
            return pd.DataFrame({c.split()[0]: [] for c in SUMS_SCHEMA.split(", ")})
        own, edge = x[:stop], np.r_[first, stop]
        per_d = {COUNT: np.repeat(np.add.reduceat(have[:stop].astype(float), first)[:, None], len(unit), 1),
                 SUM_X: np.add.reduceat(own, first)[:, which[0]]}
        for d in range(max_lag + 1):
            far = x[d:d + stop]
            if cross:
                per_d[d] = np.vstack([(own[a:b].T @ far[a:b]).ravel() for a, b in zip(edge, edge[1:])])
            else:
                per_d[d] = np.add.reduceat(own * far, first)
        size, lags = len(used) * len(unit), np.array(list(per_d))
        return pd.DataFrame({
            "unit": np.tile(unit, len(used) * len(lags)), "i": np.tile(name_i, len(used) * len(lags)), "j": np.tile(name_j, len(used) * len(lags)),
            "seg": np.tile(np.repeat(used, len(unit)), len(lags)), "d": np.repeat(lags, size), "s": np.concatenate([v.ravel() for v in per_d.values()])})

    sums = blocks.groupBy("_blk").applyInPandas(reduce_block, SUMS_SCHEMA)
    spark = rows.sparkSession
    pairs = spark.createDataFrame([tuple(map(int, p)) for p in zip(unit, name_i, name_j)], "unit int, i int, j int")
    zeros = pairs.withColumn("seg", F.explode(F.sequence(F.lit(0), F.lit(len(at) - 1)))) \
        .withColumn("d", F.explode(F.sequence(F.lit(COUNT), F.lit(max_lag)))).withColumn("s", F.lit(0.0))
    return sums.union(zeros).groupBy("unit", "i", "j", "seg", "d").agg(F.sum("s").alias("s"))


class RangeSums:
    """Shifted running sums of one unit around a job's cuts."""

    def __init__(self, job: Job, k: int, sums: dict, near: dict):
        self.job, self.k, self.near = job, k, near
        self.lag = job.lookback + job.horizon - 1
        self.shifts = np.array([*range(1, job.lookback + 1), *(-h for h in range(job.horizon))])
        self.count = {c: v[2] for c, v in sums.items()}
        self.moved = {c: self._moved(c, *v[:2]) for c, v in sums.items()}

    def _moved(self, c: int, products: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Running sums up to ``c - shift`` for every shift, from those up to ``c`` and the rows next to it."""
        left, right = self.job.lookback + 1, self.job.horizon + 1
        span = left + right
        zero = np.zeros(self.k)
        x = np.array([self.near.get(t, zero) for t in range(c - left, c + right + self.lag + 1)])
        at = left - self.shifts
        out = np.empty((self.k, self.k, self.lag + 1, len(self.shifts)))
        for d in range(self.lag + 1):
            run = np.zeros((span + 1, self.k, self.k))
            np.cumsum(x[:span, :, None] * x[d:d + span, None, :], axis=0, out=run[1:])
            out[:, :, d, :] = products[:, :, d, None] + np.moveaxis(run[at] - run[left], 0, -1)
        run = np.vstack([zero, np.cumsum(x[:span], axis=0)])
        return out, (total + run[at] - run[left]).T

    def gram(self, start: int, end: int) -> np.ndarray:
        """Over the anchors: ``[1, lag 1 of every series, .., lag L of every series, y at h = 1 of every series, ..]``."""
        w = self.moved[end][0] - self.moved[start][0]
        series = np.tile(np.arange(self.k), len(self.shifts))
        place = np.repeat(np.arange(len(self.shifts)), self.k)
        shift = self.shifts[place]
        later = shift[:, None] >= shift[None, :]                       # the column with the larger lag comes first in time
        first = np.where(later, np.arange(len(shift))[:, None], np.arange(len(shift))[None, :])
        other = np.where(later, np.arange(len(shift))[None, :], np.arange(len(shift))[:, None])
        out = np.empty((len(shift) + 1,) * 2)
        out[0, 0] = end - start
        out[0, 1:] = out[1:, 0] = (self.moved[end][1] - self.moved[start][1])[series, place]
        out[1:, 1:] = w[series[first], series[other], shift[first] - shift[other], place[first]]
        return out

    def gap(self) -> str | None:
        """The first range whose rows are not all there: rows between the cuts are
        counted by the statistics, those around them are looked up."""
        look, far = self.job.lookback, self.job.horizon - 1
        for s, e in self.job.ranges():
            have = self.count[e] - self.count[s] + sum(t in self.near for t in (*range(s - look, s), *range(e, e + far)))
            if have != e - s + look + far:
                return f"[{s - look}, {e + far})"
        return None


def solve_ridge(a: np.ndarray, b: np.ndarray, ridge: float) -> np.ndarray:
    """``(A + ridge I') W = B``; the intercept (row 0) is not penalised."""
    a = a.copy()
    at = np.arange(1, len(a))
    a[at, at] += ridge
    try:
        return np.linalg.solve(a, b)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(a, b, rcond=None)[0]


def _sse(g: np.ndarray, m: int, w: np.ndarray, y: int) -> float:
    """Squared error of the weights ``w`` of the first ``m`` columns for column ``y``."""
    return float(max(w @ g[:m, :m] @ w - 2 * w @ g[:m, y] + g[y, y], 0.0))


def solve_job(unit: int, job: Job, k: int, outs: Sequence[int], sums: dict, near: dict) -> list[tuple]:
    """Rows of ``SOLVED_SCHEMA``: one model for every series in ``outs`` and step ``h``."""
    data = RangeSums(job, k, sums, near)
    gap = data.gap()
    if gap is not None:
        return [(unit, job.name, outs[0], 0, job.lookback, None, 0, None, None, None, gap)]
    m = 1 + k * job.lookback
    grams = {name: data.gram(*r) for name, r in {"fit": job.fit, **job.evals}.items()}
    size = {name: e - s for name, (s, e) in {"fit": job.fit, **job.evals}.items()}
    g, y_of = grams["fit"], {(o, h): m + (h - 1) * k + o for o in outs for h in range(1, job.horizon + 1)}
    ys = list(y_of.values())
    weights = {r: solve_ridge(g[:m, :m], g[:m, ys], r) for r in job.ridge}
    rows = []
    for n, ((out, h), y) in enumerate(y_of.items()):
        ridge = job.ridge[0]
        if len(job.ridge) > 1:
            ridge = min((_sse(grams[job.select_on], m, weights[r][:, n], y), r) for r in job.ridge)[1]
        w = weights[ridge][:, n]
        coef = w[1:].reshape(job.lookback, k)[::-1].ravel()            # oldest step first, as windows hold it
        scores = [(name, int(size[name]), _sse(gr, m, w, y) / size[name]) for name, gr in grams.items()]
        rows.append((unit, job.name, out, h, job.lookback, float(ridge), int(size["fit"]), float(w[0]), coef.tolist(), scores, None))
    return rows


def solve(src, names: Sequence[str], jobs: Sequence[Job], outs: Sequence[int] | None = None, cross: bool = False,
          n_rows: int | None = None, idx: str = "idx", block: int | None = None) -> DataFrame:
    """Every job for every unit, stored (``SOLVED_SCHEMA`` without ``gap``). One
    statistics pass serves all jobs. Raises if rows of a range are missing."""
    plan = {j.name: j for j in jobs}
    n_rows = n_rows if n_rows is not None else (src.count if not isinstance(src, DataFrame) else src.agg(F.max(idx)).first()[0] + 1)
    for j in jobs:
        for s, e in j.ranges():
            if s < j.lookback or e <= s or e > n_rows - j.horizon + 1:
                raise ValueError(f"anchor range [{s}, {e}) is empty or out of bounds for n={n_rows}, lookback={j.lookback}, horizon={j.horizon}")
        if len(j.ridge) > 1 and j.select_on not in j.evals:
            raise ValueError(f"a ridge grid needs an evaluation range {j.select_on!r} for {j.name}")
    max_lag = max(j.lookback + j.horizon - 1 for j in jobs)
    cuts = sorted({c for j in jobs for c in j.cuts()})
    names, k = list(names), len(names) if cross else 1
    outs = list(outs if outs is not None else range(k))
    sums = lag_sums(src, names, max_lag, cuts, block or stats_block(n_rows, max_lag), cross, idx)
    spark = sums.sparkSession
    upto = Window.partitionBy("unit", "i", "j", "d").orderBy("seg").rowsBetween(Window.unboundedPreceding, 0)
    running = sums.withColumn("s", F.sum("s").over(upto))
    wanted = spark.createDataFrame([(j.name, cuts.index(c), c) for j in jobs for c in j.cuts()], "job string, seg int, cut long")
    left = running.join(wanted, "seg").groupBy("unit", "job", "cut", "i", "j") \
        .agg(F.sort_array(F.collect_list(F.struct("d", "s"))).getField("s").alias("s"))      # COUNT, SUM_X, lags 0 ..
    places = spark.createDataFrame([(j.name, max(lo, 0), hi - 1) for j in jobs for lo, hi in j.near()], "job string, lo long, hi long") \
        .select("job", F.explode(F.sequence("lo", "hi")).alias("idx")).distinct()
    x = F.array(*[col(c).cast("double") for c in names])
    close = rows_in(src, [r for j in jobs for r in j.near()], idx).select(F.col(idx).cast("long").alias("idx"), x.alias("x")).join(places, "idx")
    if cross:
        right = close.withColumn("unit", F.lit(0))
    else:
        right = close.select("job", "idx", F.posexplode("x").alias("unit", "v")).select("unit", "job", "idx", F.array("v").alias("x"))

    def one(key: tuple, sums_df: pd.DataFrame, near_df: pd.DataFrame) -> pd.DataFrame:
        unit, name = key
        job = plan[name]
        lag = job.lookback + job.horizon
        got = {}
        for cut, part in sums_df.groupby("cut"):
            products, total, count = np.zeros((k, k, lag)), np.zeros(k), 0.0
            for i, j, s in zip(part["i"], part["j"], part["s"]):
                products[i, j] = s[2:2 + lag]
                if i == j:
                    total[i], count = s[1], s[0]
            got[int(cut)] = (products, total, count)
        near = {int(t): np.asarray(v, float) for t, v in zip(near_df["idx"], near_df["x"])}
        return pd.DataFrame(solve_job(int(unit), job, k, outs, got, near), columns=list(_COLUMNS))

    solved = materialize(left.groupBy("unit", "job").cogroup(right.groupBy("unit", "job")).applyInPandas(one, SOLVED_SCHEMA), "solved")
    bad = solved.where("gap is not null").select("unit", "job", "gap").first()
    if bad is not None:
        raise ValueError(f"index of {names[bad['unit']]} has gaps inside {bad['gap']} ({bad['job']})")
    return solved.drop("gap")


_COLUMNS = ("unit", "job", "out", "h", "lookback", "ridge", "n", "intercept", "coef", "scores", "gap")
