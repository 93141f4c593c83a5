"""E: halo-block windows equal plain windows; counts, batching, shapes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rigcast.operators import windows as wn
from rigcast.plans.inspect import unpartitioned_windows


def _series(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n)
    return spark.createDataFrame([(i, float(x[i])) for i in range(n)], "idx long, v double"), x


@pytest.mark.parametrize("n,L,P,B", [(1000, 12, 5, 128), (300, 7, 1, 50), (64, 3, 4, 8)])
def test_halo_equals_plain(spark, n, L, P, B):
    df, x = _series(spark, n, seed=L)
    got = {r["idx"]: (r["x"], r["y"]) for r in wn.seq2seq_windows(df, "v", "v", L, P, block=B).collect()}
    assert len(got) == n - L - P + 1
    for a in random.Random(1).sample(sorted(got), 20):
        assert np.allclose(got[a][0], x[a - L:a]) and np.allclose(got[a][1], x[a:a + P])


def test_lookback_count_and_values(spark):
    df, x = _series(spark, 200)
    w = wn.lookback_windows(df, "v", 12, block=32).collect()
    assert len(w) == 188
    r = {r["idx"]: r for r in w}
    assert np.allclose(r[150]["x"], x[138:150]) and r[150]["y"] == x[150]


def test_short_series_is_empty(spark):
    df, _ = _series(spark, 10)
    assert wn.lookback_windows(df, "v", 12).count() == 0


def test_windows_never_cross_series(spark):
    rows = [(s, i, float(i)) for s in ("a", "b") for i in range(s == "b" and 50 or 0, s == "b" and 100 or 50)]
    df = spark.createDataFrame(rows, "s string, idx long, v double")
    w = wn.lookback_windows(df, "v", 5, series=["s"], block=16)
    assert w.count() == 2 * 45


def test_inference_reference_rule(spark):
    df, _ = _series(spark, 50)
    ends = [r["end_idx"] for r in wn.inference_windows(df, "v", 10, 50).collect()]
    assert max(ends) == 48 and min(ends) == 9
    ends = [r["end_idx"] for r in wn.inference_windows(df, "v", 10, 50, include_latest=True).collect()]
    assert max(ends) == 49


def test_batches_drop_last(spark):
    df, _ = _series(spark, 30)
    w = wn.lookback_windows(df, "v", 5)
    b = wn.batch_windows(w, 10, 5, 25)
    assert b.select("batch_id").distinct().count() == 2 and b.count() == 20


def test_shuffled_batches_repeatable(spark):
    df, _ = _series(spark, 60)
    w = wn.lookback_windows(df, "v", 5).drop("x")
    a = {r["idx"]: r["batch_id"] for r in wn.shuffled_batches(w, 10, seed=3).collect()}
    b = {r["idx"]: r["batch_id"] for r in wn.shuffled_batches(w, 10, seed=3).collect()}
    assert a == b and len(a) == 50
    assert sorted(a) != [k for k, _ in sorted(a.items(), key=lambda kv: kv[1])]


def test_horizon_slice(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],)], "p array<double>")
    assert df.select(wn.horizon_slice("p", 2).alias("s")).first()["s"] == [3.0, 4.0]


def test_multivar_shape(spark):
    df = spark.createDataFrame([(i, float(i), float(-i)) for i in range(20)], "idx long, a double, b double")
    r = {r["idx"]: r for r in wn.multivar_windows(df, ["a", "b"], "a", 3).collect()}
    assert r[10]["x"] == [[7.0, -7.0], [8.0, -8.0], [9.0, -9.0]] and r[10]["y"] == 10.0


def test_window_plan_is_partitioned(spark):
    df, _ = _series(spark, 100)
    w = wn.lookback_windows(df, "v", 5)
    assert unpartitioned_windows(w, data_columns={"v", "idx"}) == []


def test_halo_equals_numpy_random_shapes(spark):
    """Seeded random (n, L, P, B): every window equals the numpy slice."""
    rng = random.Random(42)
    for _ in range(4):
        n, L, P = rng.randint(20, 300), rng.randint(1, 15), rng.randint(1, 6)
        B = rng.randint(1, 64)
        df, x = _series(spark, n, seed=n)
        got = {r["idx"]: (r["x"], r["y"]) for r in wn.seq2seq_windows(df, "v", "v", L, P, block=B).collect()}
        assert sorted(got) == list(range(L, n - P + 1))
        for a, (xs, ys) in got.items():
            assert np.allclose(xs, x[a - L:a]) and np.allclose(ys, x[a:a + P])


def test_null_values_leave_their_windows_out(spark):
    rows = [(i, None if i in (7, 20) else float(i)) for i in range(30) if i != 25]
    df = spark.createDataFrame(rows, "idx long, v double")
    got = {r["idx"]: (r["x"], r["y"]) for r in wn.lookback_windows(df, "v", 3, block=8).collect()}
    value = dict(rows)
    want = {a: ([value[a - 3], value[a - 2], value[a - 1]], value[a]) for a in value
            if all(value.get(a - j) is not None for j in (1, 2, 3))}
    assert got == want and got[7][1] is None and 26 not in got
    seq = {r["idx"] for r in wn.seq2seq_windows(df, "v", "v", 3, 2, block=8).collect()}
    assert seq == {a for a in want if all(value.get(a + j) is not None for j in (0, 1))}
    ends = {r["end_idx"] for r in wn.inference_windows(df, "v", 3, 30, block=8, include_latest=True).collect()}
    assert ends == {a - 1 for a in [*want, 30] if all(value.get(a - j) is not None for j in (1, 2, 3))} | {24}


def test_windows_shuffle_one_row_per_block(spark):
    df, _ = _series(spark, 500)
    plan = wn.lookback_windows(df, "v", 12, block=50)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "collect_list" in plan


def test_windows_are_sliced_by_compiled_generators(spark):
    """A slice inside a lambda copies its whole block for every window."""
    df = spark.range(400).select(F.col("id").alias("idx"), F.col("id").cast("double").alias("v"))
    for w in (wn.lookback_windows(df, "v", 12, block=50), wn.seq2seq_windows(df, "v", "v", 12, 3, block=50),
              wn.inference_windows(df, "v", 12, 400, block=50), wn.lookback_stats(df, "v", 12, block=50)):
        plan = w._jdf.queryExecution().optimizedPlan().toString()
        assert "inline(array(" in plan and "transform(" not in plan and "windowspecdefinition" not in plan


def test_shuffle_works_every_round_out_once(spark):
    df = spark.range(1000).select(F.col("id").alias("idx"), F.lit("a").alias("s"))
    plan = wn.shuffled_batches(df, 10, seed=3, series=["s"])._jdf.queryExecution().optimizedPlan().toString()
    assert sum("_right" in line and "md5" in line for line in plan.splitlines() if "Generate" in line) == wn.ROUNDS
    got = wn.shuffled_batches(df, 10, seed=3, series=["s"]).select("idx", "window_no").collect()
    want = df.withColumn("at", wn.keyed_position(F.col("idx"), F.lit(1000).cast("long"), F.lit("3:a"))).collect()
    assert {r["idx"]: r["window_no"] for r in got} == {r["idx"]: r["at"] for r in want}
