"""C and D on the hand-made cases of FIXTURES.md."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rigcast.operators import scaling as sc
from rigcast.operators import splits as sp


def _idx(spark, n):
    return spark.range(n).select(F.col("id").alias("idx"), (F.col("id") * 1.0).alias("v"))


def test_borders_truncate_like_python():
    assert sp.split_border(100, 0.58) == 57
    assert sp.three_way_borders(10, 0.9, 0.0)["train"] == (0, int(10 * (1 - 0.9)))
    assert int(10 * (1 - 0.9)) == 0


def test_prefix_and_inclusive(spark):
    df = _idx(spark, 10)
    tr, te = sp.prefix_split(df, 10, 0.8)
    assert tr.count() == 8 and te.count() == 2
    tr, te = sp.inclusive_split(df, 10, 0.8)
    assert 8 in {r["idx"] for r in tr.collect()} and 8 in {r["idx"] for r in te.collect()}


def test_three_way_shares_border_rows(spark):
    parts = sp.three_way_split(_idx(spark, 100), 100, 0.2, 0.2)
    tr = {r["idx"] for r in parts["train"].collect()}
    va = {r["idx"] for r in parts["val"].collect()}
    assert max(tr) == min(va) == 60


def test_fold_bounds_formula():
    b = sp.fold_bounds(8000, 5)
    assert b[0] == (1, 1335, 2668) and b[-1] == (5, 6667, 8000)


def test_assign_folds(spark):
    f = sp.assign_folds(_idx(spark, 60), 60, 5)
    got = {(r["fold"], r["role"]): r["n"] for r in f.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got[(1, "val")] == 10 and got[(1, "train")] == 10 and got[(5, "train")] == 50


def test_seeded_repeats(spark):
    assert [r["seed"] for r in sp.seeded_repeats(spark, 4, seed=1).collect()] == [1, 2, 4, 7]


def test_standard_population_std_and_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, c double")
    p = sc.collect_params(sc.fit_standard(df, ["a", "c"]))
    assert p["a"][1] == pytest.approx(np.std([1, 2, 4]))
    assert p["a"][1] == pytest.approx(1.2472, abs=1e-4)
    assert p["c"][1] == 1.0
    out = sc.transform(df, p).collect()
    assert all(r["c"] == 0.0 for r in out)
    own = sc.collect_params(sc.fit_standard(df, ["c"], zero_std="zero"))
    assert all(math.isnan(r["c"]) for r in sc.transform(df, own).collect())


def test_minmax_constant_and_inverse(spark):
    df = spark.createDataFrame([(1.0, 3.0), (3.0, 3.0)], "a double, c double")
    p = sc.collect_params(sc.fit_minmax(df, ["a", "c"]))
    out = sc.transform(df, p).orderBy("a").collect()
    assert [r["a"] for r in out] == [0.0, 1.0] and all(r["c"] == 0.0 for r in out)
    back = sc.inverse_transform(sc.transform(df, p), p).orderBy("a").collect()
    assert [(r["a"], r["c"]) for r in back] == [(1.0, 3.0), (3.0, 3.0)]


def test_fit_scope_own_part(spark):
    tr = spark.createDataFrame([(0.0,), (2.0,)], "a double")
    te = spark.createDataFrame([(10.0,), (20.0,)], "a double")
    _, parts = sc.fit_transform(tr, {"test": te}, ["a"], fit_on="own_part")
    assert sorted(r["a"] for r in parts["test"].collect()) == [-1.0, 1.0]
    _, parts = sc.fit_transform(tr, {"test": te}, ["a"], fit_on="train")
    assert sorted(r["a"] for r in parts["test"].collect()) == [9.0, 19.0]


def test_splits_cover_without_overlap_property():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=200, deadline=None)
    @given(st.integers(1, 10_000), st.floats(0.01, 0.99), st.integers(2, 8))
    def check(n, frac, k):
        kk = sp.split_border(n, frac)
        assert 0 <= kk <= n                                  # prefix parts cover [0, n) once
        b = sp.three_way_borders(n, 0.2, 0.2)
        assert b["train"][1] == b["val"][0] and b["val"][1] == b["test"][0] and b["test"][1] == n
        if n // (k + 1) >= 1:
            f = sp.fold_bounds(n, k)
            assert f[-1][2] == n and all(f[i][2] == f[i + 1][1] for i in range(k - 1))
            assert all(ve - vs == n // (k + 1) for _, vs, ve in f)
    check()
