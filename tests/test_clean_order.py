"""Cleaning filters and the two-phase dense index."""

import math
import random

import pytest
from pyspark.sql import functions as F

from rigcast.operators.clean import (add_running_time, drop_idle_steps, drop_missing,
                                     forecast_targets, select_mode, unpivot_targets)
from rigcast.operators.order import dense_index
from rigcast.plans.inspect import unpartitioned_windows


def test_step_filter_any_order(spark):
    rows = [(1, 0.0, 1.0), (2, 1.0, 1.0), (3, float("nan"), 1.0), (4, None, 1.0), (5, 2.0, float("inf"))]
    df = spark.createDataFrame(rows, "id int, STEP double, v double")
    a = {r["id"] for r in drop_missing(drop_idle_steps(df)).collect()}
    b = {r["id"] for r in drop_idle_steps(drop_missing(df)).collect()}
    assert a == b == {2, 5}


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_dense_index_is_permutation_in_order(spark, parts):
    keys = list(range(500))
    random.Random(parts).shuffle(keys)
    df = spark.createDataFrame([(k, k * 2.0) for k in keys], "k long, v double").repartition(5)
    out = dense_index(df, ["k"], num_partitions=parts).collect()
    assert sorted(r["idx"] for r in out) == list(range(500))
    assert all(r["idx"] == r["k"] for r in out)


def test_dense_index_plan_has_no_single_task_window_over_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    out = dense_index(df, ["k"], num_partitions=4)
    assert unpartitioned_windows(out, data_columns={"k"}) == []


def test_running_time_and_targets(spark):
    df = spark.createDataFrame([(0,), (7200,)], "idx long")
    r = add_running_time(df).orderBy("idx").collect()
    assert r[1]["RUNNING_SECONDS"] == 7200 and r[1]["RUNNING_HOURS"] == 2.0
    cols = ["M1_SPEED", "VIBRATION_1", "DRIVE_POWER", "RUNNING_HOURS"]
    assert forecast_targets(cols) == ["VIBRATION_1", "DRIVE_POWER"]


def test_select_mode():
    f = ["A", "B"]
    assert select_mode(f, "B", "MS") == (["A", "B"], ["B"])
    assert select_mode(f, "B", "S") == (["B"], ["B"])
    assert select_mode(f, None, "M") == (f, f)
    with pytest.raises(ValueError):
        select_mode(f, "C", "S")


def test_unpivot(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0)], "idx long, A double, B double")
    got = sorted((r["target"], r["value"]) for r in unpivot_targets(df, ["A", "B"]).collect())
    assert got == [("A", 1.0), ("B", 2.0)]


def test_plan_check_detects_global_window(spark):
    from pyspark.sql import Window
    df = spark.range(100).select(F.col("id").alias("k"))
    bad = df.withColumn("rn", F.row_number().over(Window.orderBy("k")))
    assert unpartitioned_windows(bad, data_columns={"k"})


def test_indexed_table_between_pushes_rid_range(spark):
    from rigcast.operators.order import index_table
    from rigcast.operators.splits import prefix_split
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2.0).alias("v")).repartition(7)
    t = index_table(df, ["k"], num_partitions=5)
    assert t.count == 3000
    for lo, hi in [(0, 1), (599, 1801), (2999, 3000), (0, 3000)]:
        got = sorted(r["idx"] for r in t.between(lo, hi).collect())
        assert got == list(range(lo, hi))
    tr, te = prefix_split(t, t.count, 0.8)
    assert tr.count() == 2400 and te.count() == 600
    plan = te._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(_rid), GreaterThanOrEqual(_rid," in plan


def test_planned_broadcast_joins(spark):
    """The joins with bounded tables are broadcasts: index offsets, fold bounds,
    coefficient table."""
    from rigcast.operators import forecast as fc
    from rigcast.operators.splits import assign_folds
    from rigcast.operators.windows import lookback_windows
    from rigcast.plans.inspect import broadcast_joins
    df = spark.range(400).select(F.col("id").alias("k"), F.sin(F.col("id") * 0.1).alias("v"))
    idx = dense_index(df, ["k"], num_partitions=3)
    assert broadcast_joins(idx) >= 1
    assert broadcast_joins(assign_folds(idx, 400, 3)) >= 2
    coefs = fc.fit_ar(idx.select("idx", "v"), ["v"], 4, n_rows=400)
    w = lookback_windows(idx.select("idx", F.lit("v").alias("target"), F.col("v").alias("value")),
                         "value", 4, series=["target"])
    p = fc.predict(w, coefs)
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and broadcast_joins(p) >= 2
