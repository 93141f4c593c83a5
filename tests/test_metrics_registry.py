"""G against numpy transcriptions of the formulas; H decision cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rigcast.operators import metrics as mt
from rigcast.operators import registry as rg


def _pairs(spark, seed=0, n=40):
    rng = np.random.default_rng(seed)
    t = rng.normal(size=n) + 2
    p = t + rng.normal(scale=0.3, size=n)
    return spark.createDataFrame([("a", float(a), float(b), i // 10) for i, (a, b) in enumerate(zip(p, t))],
                                 "target string, pred double, true double, batch_id int"), p, t


def test_bundle_rse_corr(spark):
    df, p, t = _pairs(spark)
    r = mt.metric_bundle(df).first()
    assert r["mae"] == pytest.approx(np.mean(np.abs(p - t)))
    assert r["mse"] == pytest.approx(np.mean((p - t) ** 2))
    assert r["rmse"] == pytest.approx(np.sqrt(np.mean((p - t) ** 2)))
    assert r["mape"] == pytest.approx(np.mean(np.abs((p - t) / t)))
    assert r["mspe"] == pytest.approx(np.mean(np.square((p - t) / t)))
    assert mt.rse(df).first()["rse"] == pytest.approx(np.sqrt(np.sum((t - p) ** 2)) / np.sqrt(np.sum((t - t.mean()) ** 2)))
    u = ((t - t.mean()) * (p - p.mean())).sum()
    d = np.sqrt(((t - t.mean()) ** 2 * (p - p.mean()) ** 2).sum())
    assert mt.corr_ref(df).first()["corr"] == pytest.approx(u / d)


def test_batch_rmse_differs_from_rmse(spark):
    df, p, t = _pairs(spark)
    want = np.mean([np.sqrt(np.mean((p[i:i + 10] - t[i:i + 10]) ** 2)) for i in range(0, 40, 10)])
    assert mt.batch_rmse(df).first()["batch_rmse"] == pytest.approx(want)


def test_zero_true_policies(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), ("a", 3.0, 2.0)], "target string, pred double, true double")
    assert mt.metric_bundle(df).first()["mape"] == pytest.approx(0.5)
    assert math.isinf(mt.metric_bundle(df, zero_true="inf").first()["mape"])


def test_fold_summary_population_std(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 3.0, 3.0)], "target string, val_loss double, val_rmse double")
    r = mt.fold_summary(df).first()
    assert r["val_loss_mean"] == 2.0 and r["val_loss_std"] == 1.0


def _tables(spark):
    champ = spark.createDataFrame([("t1", 1.0), ("t2", 1.0), ("t3", 1.0)], "target string, test_loss double")
    chal = spark.createDataFrame([("t1", 0.5), ("t2", 1.0), ("t3", 2.0), ("t4", 9.0)], "target string, test_loss double")
    return champ, chal


def test_strict_rule(spark):
    champ, chal = _tables(spark)
    got = {r["target"]: r["promote"] for r in rg.compare_strict(chal, champ).collect()}
    assert got == {"t1": True, "t2": False, "t3": False, "t4": True}


def test_tolerance_rule(spark):
    champ, chal = _tables(spark)
    got = {r["target"]: r["promote"]
           for r in rg.compare_tolerance(chal, champ, "test_loss", None, on_missing="skip").collect()}
    assert got == {"t1": True, "t2": True, "t3": False}
    got = {r["target"]: r["promote"]
           for r in rg.compare_tolerance(chal, champ, "test_loss", -1.5, on_missing="skip").collect()}
    assert got["t3"] is True
    with pytest.raises(Exception, match="no champion metrics for t4"):
        rg.compare_tolerance(chal, champ, "test_loss").collect()
    with pytest.raises(ValueError):
        rg.compare_tolerance(chal, champ, "rmse")


def test_promote_and_versions(spark):
    champ, chal = _tables(spark)
    reg = {r["target"]: r["test_loss"] for r in rg.promote(champ, rg.compare_strict(chal, champ)).collect()}
    assert reg == {"t1": 0.5, "t2": 1.0, "t3": 1.0, "t4": 9.0}
    registry = spark.createDataFrame([("t1", 1, True)], "target string, version int, is_default boolean")
    up = spark.createDataFrame([("t1",), ("t9",)], "target string")
    got = {(r["target"], r["version"]): r["is_default"] for r in rg.register_versions(registry, up).collect()}
    assert got == {("t1", 1): False, ("t1", 2): True, ("t9", 1): True}
