"""G: error metrics as grouped aggregates over ``(pred, true)`` rows.

All metrics are built-in aggregates with partial (map-side) aggregation, so
the shuffle carries one row per group and task. Groups are targets, folds or
batches, never a whole column gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _err(pred: str, true: str) -> Column:
    return F.col(pred) - F.col(true)


def _rel(pred: str, true: str, zero_true: str) -> Column:
    """``(p - t) / t``; ``zero_true='skip'`` -> null (ignored by ``avg``),
    ``'inf'`` -> what plain float division gives (inf, or NaN for 0/0)."""
    e, t = _err(pred, true), F.col(true)
    if zero_true == "skip":
        return F.when(t != 0, e / t)
    if zero_true == "inf":
        return (F.when(t != 0, e / t).when(e == 0, F.lit(float("nan")))
                .otherwise(F.signum(e) * F.lit(float("inf"))))
    raise ValueError("zero_true must be 'skip' or 'inf'")


def mse(pred: str = "pred", true: str = "true") -> Column:
    """G1."""
    return F.avg(F.pow(_err(pred, true), 2))


def rmse(pred: str = "pred", true: str = "true") -> Column:
    """Over all samples."""
    return F.sqrt(mse(pred, true))


def mae(pred: str = "pred", true: str = "true") -> Column:
    """G4."""
    return F.avg(F.abs(_err(pred, true)))


def mape(pred: str = "pred", true: str = "true", zero_true: str = "skip") -> Column:
    """G5."""
    return F.avg(F.abs(_rel(pred, true, zero_true)))


def mspe(pred: str = "pred", true: str = "true", zero_true: str = "skip") -> Column:
    """G6."""
    return F.avg(F.pow(_rel(pred, true, zero_true), 2))


def metric_bundle(df: DataFrame, by: Sequence[str] = ("target",), pred: str = "pred",
                  true: str = "true", zero_true: str = "skip") -> DataFrame:
    """``mae, mse, rmse, mape, mspe`` per group in one aggregation."""
    return df.groupBy(*by).agg(
        mae(pred, true).alias("mae"), mse(pred, true).alias("mse"),
        rmse(pred, true).alias("rmse"), mape(pred, true, zero_true).alias("mape"),
        mspe(pred, true, zero_true).alias("mspe"))


def rse(df: DataFrame, by: Sequence[str] = ("target",), pred: str = "pred",
        true: str = "true") -> DataFrame:
    """``sqrt(sum (t-p)^2) / sqrt(sum (t - mean t)^2)`` in one pass
    (``sum (t - mean)^2 = var_pop(t) * n``)."""
    return df.groupBy(*by).agg(
        (F.sqrt(F.sum(F.pow(_err(true, pred), 2)))
         / F.sqrt(F.var_pop(true) * F.count(true))).alias("rse"))


def corr_ref(df: DataFrame, by: Sequence[str] = (), column: Sequence[str] = ("target",),
             pred: str = "pred", true: str = "true") -> DataFrame:
    """Per column ``u = sum (t - mt)(p - mp)``, ``d = sqrt(sum (t-mt)^2 (p-mp)^2)``,
    then the mean of ``u / d`` over the columns of each ``by`` group.
    (Not Pearson's correlation.) Two passes: column means, then the sums."""
    keys = [*by, *column]
    if not keys:                       # one group: join the single means row on a constant key
        df, keys = df.withColumn("_one", F.lit(1)), ["_one"]
    means = df.groupBy(*keys).agg(F.avg(true).alias("_mt"), F.avg(pred).alias("_mp"))
    j = df.join(means, keys)           # one row per group: the planner broadcasts it where it is small
    dt, dp = F.col(true) - F.col("_mt"), F.col(pred) - F.col("_mp")
    per_col = j.groupBy(*keys).agg(
        (F.sum(dt * dp) / F.sqrt(F.sum(F.pow(dt, 2) * F.pow(dp, 2)))).alias("_c"))
    return per_col.groupBy(*by).agg(F.avg("_c").alias("corr"))


def batch_rmse(df: DataFrame, by: Sequence[str] = ("target",), batch: str = "batch_id",
               pred: str = "pred", true: str = "true") -> DataFrame:
    """Mean over batches of the per-batch RMSE (two-level aggregate)."""
    per_batch = df.groupBy(*by, batch).agg(rmse(pred, true).alias("_r"))
    return per_batch.groupBy(*by).agg(F.avg("_r").alias("batch_rmse"),
                                      F.count(F.lit(1)).alias("n_batches"))


def fold_summary(folds: DataFrame, by: Sequence[str] = ("target",), loss: str = "val_loss",
                 score: str = "val_rmse") -> DataFrame:
    """Mean and population std of loss and RMSE over folds."""
    return folds.groupBy(*by).agg(
        F.avg(loss).alias("val_loss_mean"), F.stddev_pop(loss).alias("val_loss_std"),
        F.avg(score).alias("val_rmse_mean"), F.stddev_pop(score).alias("val_rmse_std"))


def test_record(df: DataFrame, run_id: str, by: Sequence[str] = ("target",), pred: str = "pred",
                true: str = "true", timestamp: str | None = None) -> DataFrame:
    """``test_loss`` (MSE) and ``test_rmse`` per target, tagged with the run."""
    out = df.groupBy(*by).agg(mse(pred, true).alias("test_loss"),
                              rmse(pred, true).alias("test_rmse"))
    out = out.withColumn("run_id", F.lit(run_id))
    if timestamp is not None:
        out = out.withColumn("timestamp", F.lit(timestamp))
    return out
