"""F: ridge autoregressive forecasters, fitted for all targets in one pass.

The batch pipelines train one sequence model per target on lookback windows
(or one on all of them, in modes M and MS). Here the model is a ridge
regression of ``y = x[a + h - 1]`` on the lags ``x[a-L .. a-1]`` of the target
itself or of all features (plus intercept), in closed form. Windows are never
materialised for the fit: ``operators.lagfit`` reduces the rows to lagged
sums in one pass and solves every model on the executors.
Prediction (F3/F4) is a native dot product over windows, or a matrix product
per halo block.
"""

from __future__ import annotations

import math
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigcast.operators.clean import col, select_mode
from rigcast.operators.lagfit import Job, solve
from rigcast.operators.order import rows_in
from rigcast.operators.windows import halo_blocks

COEF_SCHEMA = ("target string, fit string, h int, lookback int, ridge double, n long, "
               "intercept double, coef array<double>")


# ---------------------------------------------------------------- fitting

@dataclass
class FitResult:
    coefs: DataFrame          # COEF_SCHEMA
    scores: DataFrame         # (target, fit, range, h, n, mse)


def _result(solved: DataFrame, names: Sequence[str], cross: bool) -> FitResult:
    """Names instead of positions; the stored rows are as many as the configuration has models."""
    target = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("out" if cross else "unit") + 1)
    rows = solved.withColumn("target", target).withColumnRenamed("job", "fit")
    scores = rows.select("target", "fit", "h", F.inline("scores")).select("target", "fit", "range", "h", "n", "mse")
    return FitResult(rows.select(*[c.split()[0] for c in COEF_SCHEMA.split(", ")]), scores)


def _jobs(lookback: int, fits: Mapping, evals: Mapping | None, ridge, horizon: int, select_on: str) -> list[Job]:
    grid = tuple(float(r) for r in ridge) if isinstance(ridge, (list, tuple)) else (float(ridge),)
    return [Job(name, lookback, r, dict((evals or {}).get(name, {})), grid, select_on, horizon) for name, r in fits.items()]


def fit_ranges(df, targets: Sequence[str], lookback: int,
               fits: Mapping[str, tuple[int, int]],
               evals: Mapping[str, Mapping[str, tuple[int, int]]] | None = None,
               ridge: float | Sequence[float] = 1e-3, horizon: int = 1, n_rows: int | None = None,
               idx: str = "idx", block: int | None = None, select_on: str = "tail") -> FitResult:
    """fit one ridge AR model per ``(target, fit, h)`` on the anchor
    ranges in ``fits`` and score it on the anchor ranges ``evals[fit]``.
    All ranges are served by one statistics pass over ``df`` (a DataFrame with
    dense ``idx`` and one column per target, or a stored index whose scan takes
    the ranges). Raises if a range is too short or has gaps.
    A sequence of ``ridge`` values is a grid: per ``(target, fit, h)`` the
    value with the lowest MSE on ``evals[fit][select_on]`` is kept."""
    jobs = _jobs(lookback, fits, evals, ridge, horizon, select_on)
    return _result(solve(df, targets, jobs, n_rows=n_rows, idx=idx, block=block), targets, False)


def fit_vector(df, features: Sequence[str], targets: Sequence[str], lookback: int,
               fits: Mapping[str, tuple[int, int]],
               evals: Mapping[str, Mapping[str, tuple[int, int]]] | None = None,
               ridge: float | Sequence[float] = 1e-3, horizon: int = 1, n_rows: int | None = None,
               idx: str = "idx", block: int | None = None, select_on: str = "tail") -> FitResult:
    """Vector autoregression: every target is regressed on the lags of *all*
    ``features`` (modes M and MS). ``coef`` holds the oldest step first and
    within a step the features in order, as flattened multivariate windows do.
    ``targets`` must be among ``features``."""
    names = list(features)
    missing = [t for t in targets if t not in names]
    if missing:
        raise ValueError(f"targets not among the features: {missing}")
    jobs = _jobs(lookback, fits, evals, ridge, horizon, select_on)
    solved = solve(df, names, jobs, [names.index(t) for t in targets], True, n_rows, idx, block)
    return _result(solved, names, True)


def fit_mode(df, features: Sequence[str], target: str | None, mode: str, lookback: int, fits: Mapping,
             evals: Mapping | None = None, **options) -> FitResult:
    """F1 in mode ``M`` (all features predict all), ``MS`` (all predict one) or ``S`` (one predicts itself)."""
    inputs, outputs = select_mode(features, target, mode)
    if mode == "S":
        return fit_ranges(df, outputs, lookback, fits, evals, **options)
    return fit_vector(df, inputs, outputs, lookback, fits, evals, **options)


def fit_ar(df, targets: Sequence[str], lookback: int, start: int | None = None,
           end: int | None = None, ridge: float = 1e-3, horizon: int = 1,
           n_rows: int | None = None, idx: str = "idx") -> DataFrame:
    """one model per target on anchors ``[start, end)`` (default: every
    anchor with a full lookback). Returns the coefficient table."""
    if n_rows is None:
        n_rows = df.agg(F.max(idx)).first()[0] + 1 if isinstance(df, DataFrame) else df.count
    s = lookback if start is None else start
    e = (n_rows - horizon + 1) if end is None else end
    if e - s < 1:
        raise ValueError(f"{n_rows} rows are too few for lookback {lookback}")
    return fit_ranges(df, targets, lookback, {"full": (s, e)}, ridge=ridge, horizon=horizon,
                      n_rows=n_rows, idx=idx).coefs


def cross_validate(df, targets: Sequence[str], lookback: int, n_rows: int, folds: int,
                   ridge: float | Sequence[float] = 1e-3, val_size: float | None = None,
                   idx: str = "idx") -> FitResult:
    """expanding-window CV (C4 bounds on ``[0, n_rows)``). Fold ``j`` fits on
    the anchors of its training prefix (C5: without the last ``val_size`` share
    of its windows) and is scored on windows built *inside* its validation
    slice (anchors from ``val_start + lookback``). Scores give loss = MSE and
    RMSE per fold; the last fold's model is the one kept by the pipelines.
    With a grid of ``ridge`` values the C5 tail (the held-out last windows of
    the fold's training part) picks the value, as the hold-out share picks
    the stopping epoch in the batch pipelines. One statistics pass serves
    every fold, grid value and score."""
    from rigcast.operators.splits import fold_bounds
    grid = isinstance(ridge, (list, tuple)) and len(ridge) > 1
    if grid and not val_size:
        raise ValueError("a ridge grid needs val_size (the hold-out tail that picks it)")
    fits, evals = {}, {}
    for fold, vs, ve in fold_bounds(n_rows, folds):
        m = vs - lookback
        end = lookback + (int(m * (1 - val_size)) if val_size else m)
        fits[f"fold{fold}"] = (lookback, end)
        evals[f"fold{fold}"] = {"val": (vs + lookback, ve)}
        if grid:
            evals[f"fold{fold}"]["tail"] = (end, vs)
    return fit_ranges(df, targets, lookback, fits, evals, ridge=ridge, n_rows=n_rows, idx=idx)


def fold_scores(res: FitResult) -> DataFrame:
    """Per ``(target, fold)``: ``val_loss`` (MSE) and ``val_rmse``."""
    v = res.scores.where(F.col("range") == "val")
    return v.select("target", F.regexp_extract("fit", r"(\d+)$", 1).cast("int").alias("fold"),
                    F.col("mse").alias("val_loss"), F.sqrt("mse").alias("val_rmse"))


# ---------------------------------------------------------------- prediction

def dot_expr(x: str = "x", coef: str = "coef"):
    """Native dot product of two arrays (no UDF)."""
    return F.aggregate(F.zip_with(F.col(x), F.col(coef), lambda a, b: a * b),
                       F.lit(0.0), lambda acc, v: acc + v)


def predict(windows: DataFrame, coefs: DataFrame, on: Sequence[str] = ("target",),
            x: str = "x", out: str = "pred") -> DataFrame:
    """``pred = intercept + x . coef``. The coefficient table has one row
    per (target, fit, h): bounded by configuration, so it is broadcast."""
    c = coefs.select(*on, "intercept", "coef")
    return (windows.join(F.broadcast(c), list(on))
            .withColumn(out, F.col("intercept") + dot_expr(x, "coef"))
            .drop("intercept", "coef"))


def predict_horizon(windows: DataFrame, coefs: DataFrame, on: Sequence[str] = ("target",),
                    x: str = "x", out: str = "pred") -> DataFrame:
    """direct multi-step forecast, ``pred`` = array over ``h = 1..P``."""
    grouped = coefs.groupBy(*on).agg(
        F.sort_array(F.collect_list(F.struct("h", "intercept", "coef"))).alias("_m"))
    joined = windows.join(F.broadcast(grouped), list(on))
    step = F.transform("_m", lambda m: m["intercept"] + F.aggregate(
        F.zip_with(F.col(x), m["coef"], lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v))
    return joined.withColumn(out, step).drop("_m")


def forecast_blocks(series: DataFrame, coefs: DataFrame, lookback: int, horizon: int = 1,
                    key: str = "target", value: str = "value", idx: str = "idx",
                    block: int | None = None) -> DataFrame:
    """F3/F4 on a long series without materialised windows: rows
    ``(key, idx, h, pred, true)`` for every anchor with a full lookback and a
    full horizon of true values. Halo blocks of the series are grouped by
    ``(key, block)`` (bounded size); each block is one numpy product of its
    lag matrix with the ``lookback x horizon`` coefficient matrix. The
    coefficient table is collected (one row per key and horizon: bounded by
    configuration) and shipped with the task."""
    rows = coefs.select(key, "h", "intercept", "coef").collect()
    table: dict = {}
    for r in rows:
        table.setdefault(r[key], {})[r["h"]] = (r["intercept"], np.asarray(r["coef"], dtype=float))
    model = {k: (np.array([v[h][0] for h in range(1, horizon + 1)]),
                 np.column_stack([v[h][1] for h in range(1, horizon + 1)]))
             for k, v in table.items() if all(h in v for h in range(1, horizon + 1))}
    b = block or max(1 << 14, 20 * (lookback + horizon))
    blocks, _ = halo_blocks(series.select(col(key).alias("_k"), F.col(idx).alias("_i"), col(value).alias("_v")),
                            lookback, horizon - 1, b, "_i")
    blocks = blocks.drop("_own")

    def one_block(pdf: pd.DataFrame) -> pd.DataFrame:
        k = pdf["_k"].iloc[0]
        blk = int(pdf["_blk"].iloc[0])
        empty = pd.DataFrame({"_k": pd.Series([], dtype=object), "idx": np.array([], np.int64),
                              "h": np.array([], np.int32), "pred": np.array([], float), "true": np.array([], float)})
        if k not in model:
            return empty
        icpt, C = model[k]
        start = blk * b - lookback                      # position 0 of the local array
        width = lookback + b + horizon - 1
        pos = pdf["_i"].to_numpy(np.int64) - start
        ok = (pos >= 0) & (pos < width)
        x = np.zeros(width)
        have = np.zeros(width, dtype=bool)
        x[pos[ok]] = pdf["_v"].to_numpy(float)[ok]
        have[pos[ok]] = True
        csum = np.concatenate([[0], np.cumsum(have)])
        anchors = lookback + np.arange(b)               # local positions of the block's anchors
        full = (csum[anchors] - csum[anchors - lookback] == lookback) & \
               (csum[np.minimum(anchors + horizon, width)] - csum[anchors] == horizon) & \
               (anchors + horizon <= width)
        a = anchors[full]
        if a.size == 0:
            return empty
        lag = np.lib.stride_tricks.sliding_window_view(x, lookback)[a - lookback]   # x[a-L .. a-1]
        pred = lag @ C + icpt                                                           # (m, P)
        true = np.lib.stride_tricks.sliding_window_view(x, horizon)[a]                 # x[a .. a+P-1]
        m = a.size
        return pd.DataFrame({"_k": np.repeat(np.array([k], dtype=object), m * horizon),
                             "idx": np.repeat(a + start, horizon).astype(np.int64),
                             "h": np.tile(np.arange(1, horizon + 1), m).astype(np.int32),
                             "pred": pred.ravel(), "true": true.ravel()})

    out = blocks.groupBy("_k", "_blk").applyInPandas(
        one_block, "_k string, idx long, h int, pred double, true double")
    return out.withColumnRenamed("_k", key)


def predict_blocks(src, start: int, end: int, coefs: DataFrame, features: Sequence[str], targets: Sequence[str], lookback: int,
                   horizon: int = 1, idx: str = "idx", block: int | None = None) -> DataFrame:
    """F3/F4 for every anchor whose window and horizon lie in rows ``[start, end)``:
    ``(target, idx, h, pred, true)``. One wide row per index is copied to its
    halo block (all features together, no row per target); a block multiplies
    its lag matrix, some anchors at a time, with the coefficients. A model whose
    coefficients number ``lookback`` reads its own target, one with ``lookback
    x features`` reads them all. The coefficient table has one row per target
    and step (bounded by configuration) and goes with the task."""
    names, wanted = list(features), list(targets)
    rows = coefs.where(F.col("target").isin(wanted)).select("target", "h", "intercept", "coef").collect()
    models: dict = {}
    for r in rows:
        models.setdefault(r["target"], {})[r["h"]] = (r["intercept"], np.asarray(r["coef"], float))
    steps = range(1, horizon + 1)
    models = {t: (np.array([m[h][0] for h in steps]), np.column_stack([m[h][1] for h in steps])) for t, m in models.items() if all(h in m for h in steps)}
    b = block or max(1 << 14, 20 * (lookback + horizon))
    part = rows_in(src, [(start, end)], idx)
    blocks, _ = halo_blocks(part.select(F.col(idx).alias("_i"), F.array(*[col(c).cast("double") for c in names]).alias("x")),
                            lookback, horizon - 1, b, "_i")

    def one_block(pdf: pd.DataFrame) -> pd.DataFrame:
        low = int(pdf["_blk"].iloc[0]) * b - lookback
        width = lookback + b + horizon - 1
        pos = pdf["_i"].to_numpy(np.int64) - low
        x, have = np.zeros((width, len(names))), np.zeros(width, bool)
        x[pos], have[pos] = np.vstack(pdf["x"].to_numpy()), True
        run = np.r_[0, np.cumsum(have)]
        at = lookback + np.arange(b)
        at = at[run[at + horizon] - run[at - lookback] == lookback + horizon]
        out = []
        chunk = max(1, (1 << 22) // (lookback * len(names)))
        for lo in range(0, len(at), chunk):
            a = at[lo:lo + chunk]
            past = np.lib.stride_tricks.sliding_window_view(x, lookback, axis=0)[a - lookback]          # (m, features, lookback)
            wide = None
            for t, (icpt, c) in models.items():
                own = names.index(t)
                if len(c) == lookback:
                    lag = past[:, own]
                else:
                    if wide is None:
                        wide = past.transpose(0, 2, 1).reshape(len(a), -1)
                    lag = wide
                true = np.lib.stride_tricks.sliding_window_view(x[:, own], horizon)[a]
                out.append(pd.DataFrame({"target": t, "idx": np.repeat(a + low, horizon), "h": np.tile(np.arange(1, horizon + 1), len(a)),
                                         "pred": (lag @ c + icpt).ravel(), "true": true.ravel()}))
        if not out:                                     # a block at an edge of the rows may have no anchor; an untyped empty column is no text
            return pd.DataFrame({"target": np.array([], object), "idx": np.array([], np.int64), "h": np.array([], np.int32),
                                 "pred": np.array([], float), "true": np.array([], float)})
        return pd.concat(out)

    return blocks.groupBy("_blk").applyInPandas(one_block, "target string, idx long, h int, pred double, true double")


# ---------------------------------------------------------------- search

def trial_table(spark: SparkSession, n_trials: int, seed: int, lookback_range: tuple[int, int],
                ridge_range: tuple[float, float]) -> DataFrame:
    """trial parameters drawn with ``rand(seed)``: integer lookback
    (uniform) and ridge strength (log-uniform)."""
    lo, hi = lookback_range
    rlo, rhi = math.log(ridge_range[0]), math.log(ridge_range[1])
    return spark.range(n_trials).select(
        F.col("id").cast("int").alias("trial"),
        (F.lit(lo) + F.floor(F.rand(seed) * (hi - lo + 1))).cast("int").alias("lookback"),
        F.exp(F.lit(rlo) + F.rand(seed + 1) * (rhi - rlo)).alias("ridge"))


def trial_search(df, targets: Sequence[str], n_rows: int, train_end: int,
                 trials: DataFrame, val_size: float = 0.1, select_on: str = "val",
                 idx: str = "idx") -> tuple[DataFrame, DataFrame]:
    """score every trial for every target and keep the best per target.

    ``select_on='val'`` fits on the train part without its last ``val_size``
    share and scores on windows inside that tail; ``'test'`` fits on the whole
    train part and scores on windows inside ``[train_end, n_rows)`` (the
    reference's rule). One statistics pass serves every trial, and every
    (target, trial) is a group of its own. Returns ``(trials, best)``; ``best``
    is picked with ``min_by`` per target."""
    plan = trials.select("trial", "lookback", "ridge").collect()   # bounded by the trial budget
    vb = int(train_end * (1 - val_size))
    jobs = []
    for r in plan:
        look = r["lookback"]
        fit, scored = ((look, vb), (vb + look, train_end)) if select_on == "val" else ((look, train_end), (train_end + look, n_rows))
        jobs.append(Job(str(r["trial"]), look, fit, {"score": scored}, (float(r["ridge"]),)))
    res = _result(solve(df, targets, jobs, n_rows=n_rows, idx=idx), targets, False)
    out = res.scores.where(F.col("range") == "score").join(res.coefs.select("target", "fit", "lookback", "ridge"), ["target", "fit"]) \
        .select("target", F.col("fit").cast("int").alias("trial"), F.struct("lookback", "ridge").alias("params"), F.sqrt("mse").alias("rmse"))
    best = out.groupBy("target").agg(F.min_by("params", "rmse").alias("params"),
                                     F.min("rmse").alias("rmse"))
    return out, best


Range = tuple[float, float]


def propose(history: Sequence[tuple[int, float, float]], count: int, rng: np.random.Generator, lookback_range: tuple[int, int],
            ridge_range: Range, startup: int = 10, good_share: float = 0.2, tries: int = 32) -> list[tuple[int, float]]:
    """The next ``count`` trials ``(lookback, ridge)`` for one target from its
    ``history`` of ``(lookback, ridge, score)`` (lower is better). Until ``startup``
    trials are known they are uniform. Then the best share of the history and the
    rest each give a kernel density over the unit square of the two parameters
    (ridge by its logarithm), and of some draws from the density of the good ones
    the one is taken where it exceeds that of the others most."""
    low = np.array([lookback_range[0], math.log(ridge_range[0])], float)
    span = np.array([lookback_range[1], math.log(ridge_range[1])], float) - low
    span[span == 0] = 1.0

    def trial(u: np.ndarray) -> tuple[int, float]:
        x = low + np.clip(u, 0, 1) * span
        return int(round(x[0])), float(np.exp(x[1]))

    known = sorted((h for h in history if math.isfinite(h[2])), key=lambda h: h[2])
    if len(known) < startup:
        return [trial(rng.random(2)) for _ in range(count)]
    points = (np.array([[h[0], math.log(h[1])] for h in known]) - low) / span
    n_good = max(2, math.ceil(good_share * len(known)))
    good, bad = points[:n_good], points[n_good:]

    def density(at: np.ndarray, centres: np.ndarray) -> np.ndarray:
        width = max(0.05, 0.5 * len(centres) ** -0.4)
        d = ((at[:, None, :] - centres[None]) ** 2).sum(-1)
        return (1 + (np.exp(-d / (2 * width**2)) / (2 * math.pi * width**2)).sum(1)) / (len(centres) + 1)    # one part uniform

    out = []
    for _ in range(count):
        width = max(0.05, 0.5 * n_good ** -0.4)
        near = good[rng.integers(0, n_good, tries)] + width * rng.normal(size=(tries, 2))
        draws = np.vstack([np.clip(near, 0, 1), rng.random((2, 2))])
        best = draws[np.argmax(density(draws, good) / density(draws, bad))]
        out.append(trial(best))
        bad = np.vstack([bad, best])                     # the next of this generation looks elsewhere
    return out


def adaptive_search(df, targets: Sequence[str], n_rows: int, train_end: int, lookback_range: tuple[int, int], ridge_range: Range,
                    budget: int = 100, generation: int = 25, seconds: float = 1000.0, seed: int = 0, val_size: float = 0.1,
                    select_on: str = "val", idx: str = "idx", clock=time.monotonic) -> tuple[DataFrame, DataFrame]:
    """F6, adaptive: generations of trials, each from the scores so far, until
    ``budget`` trials are done or ``seconds`` have passed (checked between
    generations; the first always runs). A generation is one statistics pass; its
    trials are proposed by the targets in turn and scored for every target.
    Returns ``(trials, best)`` as ``trial_search`` does; scores kept on the driver
    number ``budget x targets``."""
    spark = (df if isinstance(df, DataFrame) else df.frame()).sparkSession
    rng, begin, done, out = np.random.default_rng(seed), clock(), 0, None
    history: dict[str, list] = {t: [] for t in targets}
    while done < budget and (done == 0 or clock() - begin < seconds):
        size = min(generation, budget - done)
        share = [size // len(history) + (i < size % len(history)) for i in range(len(history))]
        rows = [p for t, n in zip(history, share) for p in propose(history[t], n, rng, lookback_range, ridge_range)]
        table = spark.createDataFrame([(done + i, look, ridge) for i, (look, ridge) in enumerate(rows)], "trial int, lookback int, ridge double")
        scored, _ = trial_search(df, targets, n_rows, train_end, table, val_size, select_on, idx)
        for r in scored.collect():
            history[r["target"]].append((r["params"]["lookback"], r["params"]["ridge"], r["rmse"]))
        out = scored if out is None else out.unionByName(scored)
        done += size
    best = out.groupBy("target").agg(F.min_by("params", "rmse").alias("params"), F.min("rmse").alias("rmse"))
    return out, best
