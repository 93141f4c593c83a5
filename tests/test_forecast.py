"""F: the statistics-based ridge fit equals a brute-force fit on explicit windows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rigcast.operators import forecast as fc
from rigcast.operators.splits import fold_bounds


def _series(spark, n, k=2, seed=0):
    rng = np.random.default_rng(seed)
    cols = {}
    for j in range(k):
        e = rng.normal(size=n)
        x = np.zeros(n)
        for t in range(n):
            x[t] = 0.6 * x[t - 1] - 0.2 * x[t - 2] + e[t] if t >= 2 else e[t]
        cols[f"s{j}"] = x + j
    rows = [(i, *[float(cols[c][i]) for c in cols]) for i in range(n)]
    df = spark.createDataFrame(rows, "idx long, " + ", ".join(f"{c} double" for c in cols))
    return df, cols


def _brute(x, L, start, end, ridge, h=1):
    X = np.array([[1.0, *x[a - L:a][::-1]] for a in range(start, end)])
    y = np.array([x[a + h - 1] for a in range(start, end)])
    A = X.T @ X
    A[1:, 1:] += ridge * np.eye(L)
    return np.linalg.solve(A, X.T @ y), X, y


@pytest.mark.parametrize("block", [64, 1000])
def test_fit_matches_numpy(spark, block):
    n, L = 700, 7
    df, cols = _series(spark, n)
    res = fc.fit_ranges(df, list(cols), L, {"a": (L, 500), "b": (30, 650)},
                        evals={"a": {"v": (520, 700)}}, ridge=0.5, n_rows=n, block=block)
    coefs = {(r["target"], r["fit"]): r for r in res.coefs.collect()}
    scores = {(r["target"], r["fit"], r["range"]): r["mse"] for r in res.scores.collect()}
    for name, x in cols.items():
        for fit, (s, e) in {"a": (L, 500), "b": (30, 650)}.items():
            w, X, y = _brute(x, L, s, e, 0.5)
            r = coefs[(name, fit)]
            assert r["intercept"] == pytest.approx(w[0], abs=1e-9)
            assert np.allclose(r["coef"], w[1:][::-1], atol=1e-9)
            assert scores[(name, fit, "fit")] == pytest.approx(np.mean((X @ w - y) ** 2), rel=1e-9)
        wa, _, _ = _brute(x, L, L, 500, 0.5)
        Xv = np.array([[1.0, *x[a - L:a][::-1]] for a in range(520, 700)])
        assert scores[(name, "a", "v")] == pytest.approx(np.mean((Xv @ wa - x[520:700]) ** 2), rel=1e-9)


def test_multi_horizon_matches_numpy(spark):
    n, L, P = 400, 5, 3
    df, cols = _series(spark, n, k=1, seed=3)
    coefs = fc.fit_ar(df, list(cols), L, ridge=0.1, horizon=P, n_rows=n)
    got = {r["h"]: r for r in coefs.collect()}
    x = cols["s0"]
    for h in range(1, P + 1):
        w, _, _ = _brute(x, L, L, n - P + 1, 0.1, h)
        assert got[h]["intercept"] == pytest.approx(w[0], abs=1e-9)
        assert np.allclose(got[h]["coef"], w[1:][::-1], atol=1e-9)


def test_cross_validate_matches_numpy(spark):
    n, L, k = 600, 6, 3
    df, cols = _series(spark, n, k=1, seed=5)
    res = fc.cross_validate(df, ["s0"], L, n, k, ridge=0.01, val_size=0.2)
    got = {r["fold"]: r for r in fc.fold_scores(res).collect()}
    x = cols["s0"]
    for fold, vs, ve in fold_bounds(n, k):
        m = vs - L
        w, _, _ = _brute(x, L, L, L + int(m * 0.8), 0.01)
        Xv = np.array([[1.0, *x[a - L:a][::-1]] for a in range(vs + L, ve)])
        mse = np.mean((Xv @ w - x[vs + L:ve]) ** 2)
        assert got[fold]["val_loss"] == pytest.approx(mse, rel=1e-9)
        assert got[fold]["val_rmse"] == pytest.approx(np.sqrt(mse), rel=1e-9)


def test_native_predict_matches_numpy(spark):
    from rigcast.operators.windows import lookback_windows
    n, L = 300, 4
    df, cols = _series(spark, n, k=1, seed=9)
    coefs = fc.fit_ar(df, ["s0"], L, ridge=0.0, n_rows=n)
    long = df.select("idx", F.lit("s0").alias("target"), F.col("s0").alias("value"))
    w = lookback_windows(long, "value", L, series=["target"])
    pred = {r["idx"]: r["pred"] for r in fc.predict(w, coefs).collect()}
    c = coefs.first()
    x = cols["s0"]
    for a in (L, 100, n - 1):
        assert pred[a] == pytest.approx(c["intercept"] + np.dot(x[a - L:a], c["coef"]), abs=1e-9)
    assert len(pred) == n - L


def test_short_series_raises(spark):
    df, cols = _series(spark, 10, k=1)
    with pytest.raises(ValueError):
        fc.fit_ar(df, ["s0"], 12, n_rows=10)


def test_linear_regression_cross_check(spark):
    """The normal-equation solution agrees with Spark ML's LinearRegression."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression
    from rigcast.operators.windows import lookback_windows
    n, L = 500, 3
    df, cols = _series(spark, n, k=1, seed=11)
    coefs = fc.fit_ar(df, ["s0"], L, ridge=0.0, n_rows=n).first()
    long = df.select("idx", F.col("s0").alias("value"))
    w = lookback_windows(long, "value", L).select(array_to_vector("x").alias("features"), F.col("y").alias("label"))
    m = LinearRegression(solver="normal", regParam=0.0).fit(w)
    assert m.intercept == pytest.approx(coefs["intercept"], abs=1e-6)
    assert np.allclose(m.coefficients.toArray(), coefs["coef"], atol=1e-6)


def test_trial_search_picks_min(spark):
    n = 500
    df, cols = _series(spark, n, k=2, seed=2)
    trials = fc.trial_table(spark, 6, seed=1, lookback_range=(2, 8), ridge_range=(1e-3, 1.0))
    tab, best = fc.trial_search(df, list(cols), n, 400, trials, val_size=0.2)
    t = tab.groupBy("target").agg(F.min("rmse").alias("m")).collect()
    b = {r["target"]: r["rmse"] for r in best.collect()}
    for r in t:
        assert b[r["target"]] == pytest.approx(r["m"])
    assert tab.count() == 12


def test_prefix_fit_with_blocks_past_last_cut(spark):
    n, L = 700, 4
    df, cols = _series(spark, n, k=1, seed=4)
    res = fc.fit_ranges(df, ["s0"], L, {"p": (L, 150)}, ridge=0.2, n_rows=n, block=32)
    r = res.coefs.first()
    w, _, _ = _brute(cols["s0"], L, L, 150, 0.2)
    assert np.allclose(r["coef"], w[1:][::-1], atol=1e-9) and r["intercept"] == pytest.approx(w[0], abs=1e-9)


def test_forecast_blocks_equals_window_predict(spark):
    from rigcast.operators.windows import seq2seq_windows
    n, L, P = 400, 6, 3
    df, cols = _series(spark, n, k=2, seed=13)
    coefs = fc.fit_ar(df, list(cols), L, ridge=0.3, horizon=P, n_rows=n)
    long = df.unpivot(["idx"], list(cols), "target", "value")
    blk = {(r["target"], r["idx"], r["h"]): (r["pred"], r["true"])
           for r in fc.forecast_blocks(long, coefs, L, P, block=50).collect()}
    w = seq2seq_windows(long, "value", "value", L, P, series=["target"])
    win = fc.predict_horizon(w, coefs).collect()
    assert len(blk) == len(win) * P == 2 * (n - L - P + 1) * P
    for r in win:
        for h in range(P):
            p, t = blk[(r["target"], r["idx"], h + 1)]
            assert p == pytest.approx(r["pred"][h], abs=1e-9) and t == r["y"][h]


def test_predict_blocks_at_edges_without_anchors(spark):
    """The first and the last block hold fewer rows than one window needs: they give no rows and no error."""
    n, L, P = 230, 6, 3
    df, cols = _series(spark, n, k=2, seed=14)
    coefs = fc.fit_ar(df, list(cols), L, ridge=0.3, horizon=P, n_rows=n)
    for start, end in ((97, 204), (97, 100)):
        got = fc.predict_blocks(df, start, end, coefs, list(cols), list(cols), L, P, block=100).collect()
        assert len(got) == 2 * P * max(0, end - start - L - P + 1)
        assert all(r["true"] == cols[r["target"]][r["idx"] + r["h"] - 1] for r in got)


def test_ridge_grid_picked_on_tail(spark):
    n, L, k = 600, 5, 3
    df, cols = _series(spark, n, k=1, seed=21)
    grid = [1e-4, 10.0, 1e4]
    res = fc.cross_validate(df, ["s0"], L, n, k, ridge=grid, val_size=0.25)
    x = cols["s0"]
    got = {r["fit"]: r for r in res.coefs.collect()}
    for fold, vs, ve in fold_bounds(n, k):
        m = vs - L
        end = L + int(m * 0.75)
        Xt = np.array([[1.0, *x[a - L:a][::-1]] for a in range(end, vs)])
        best = min(grid, key=lambda r: np.mean((Xt @ _brute(x, L, L, end, r)[0] - x[end:vs]) ** 2))
        r = got[f"fold{fold}"]
        assert r["ridge"] == best
        w, _, _ = _brute(x, L, L, end, best)
        assert np.allclose(r["coef"], w[1:][::-1], atol=1e-8)
    with pytest.raises(ValueError):
        fc.cross_validate(df, ["s0"], L, n, k, ridge=grid)


def _vector_brute(x, outs, L, start, end, ridge, h=1):
    """Ridge regression of every column in ``outs`` on the flattened windows of all columns."""
    X = np.array([[1.0, *x[a - L:a].ravel()] for a in range(start, end)])
    Y = np.array([x[a + h - 1, outs] for a in range(start, end)])
    A = X.T @ X
    A[1:, 1:] += ridge * np.eye(X.shape[1] - 1)
    return np.linalg.solve(A, X.T @ Y), X, Y


@pytest.mark.parametrize("k,L,block", [(2, 1, 64), (11, 4, 200), (3, 7, None)])
def test_vector_fit_matches_numpy(spark, k, L, block):
    n = 600
    df, cols = _series(spark, n, k=k, seed=k)
    names, x = list(cols), np.column_stack(list(cols.values()))
    outs = [0, k - 1]
    res = fc.fit_vector(df, names, [names[o] for o in outs], L, {"a": (L, 400), "b": (50, 560)}, {"a": {"v": (420, 600)}},
                        ridge=0.7, n_rows=n, block=block)
    coefs = {(r["target"], r["fit"]): r for r in res.coefs.collect()}
    scores = {(r["target"], r["fit"], r["range"]): r["mse"] for r in res.scores.collect()}
    for fit, (s, e) in {"a": (L, 400), "b": (50, 560)}.items():
        w, X, Y = _vector_brute(x, outs, L, s, e, 0.7)
        for n_out, o in enumerate(outs):
            r = coefs[(names[o], fit)]
            assert r["intercept"] == pytest.approx(w[0, n_out], abs=1e-8)
            assert np.allclose(r["coef"], w[1:, n_out], atol=1e-8)
            assert scores[(names[o], fit, "fit")] == pytest.approx(np.mean((X @ w - Y)[:, n_out] ** 2), rel=1e-8)
    w, _, _ = _vector_brute(x, outs, L, L, 400, 0.7)
    X = np.array([[1.0, *x[a - L:a].ravel()] for a in range(420, 600)])
    assert scores[(names[0], "a", "v")] == pytest.approx(np.mean((X @ w[:, 0] - x[420:, 0]) ** 2), rel=1e-8)


def test_vector_horizon_grid_and_blocks(spark):
    n, L, P, k = 500, 3, 3, 4
    df, cols = _series(spark, n, k=k, seed=8)
    names, x = list(cols), np.column_stack(list(cols.values()))
    res = fc.fit_vector(df, names, names[:2], L, {"f": (L, 300)}, {"f": {"tail": (300, 380)}}, ridge=[1e-3, 1.0, 1e4], horizon=P, n_rows=n)
    coefs = {(r["target"], r["h"]): r for r in res.coefs.collect()}
    assert len(coefs) == 2 * P
    pred = {(r["target"], r["idx"], r["h"]): (r["pred"], r["true"])
            for r in fc.predict_blocks(df, 400, n, res.coefs, names, names[:2], L, P, block=32).collect()}
    assert len(pred) == 2 * P * (100 - L - P + 1)
    for (t, a, h), (p, true) in pred.items():
        r = coefs[(t, h)]
        assert true == x[a + h - 1, names.index(t)]
        assert p == pytest.approx(r["intercept"] + np.dot(x[a - L:a].ravel(), r["coef"]), abs=1e-9)
    for o in (0, 1):
        for h in range(1, P + 1):
            errors = {}
            for ridge in (1e-3, 1.0, 1e4):
                w, _, _ = _vector_brute(x, [o], L, L, 300, ridge, h)
                X = np.array([[1.0, *x[a - L:a].ravel()] for a in range(300, 380)])
                errors[ridge] = np.mean((X @ w[:, 0] - x[300 + h - 1:380 + h - 1, o]) ** 2)
            assert coefs[(names[o], h)]["ridge"] == min(errors, key=errors.get)


def test_modes_choose_inputs_and_outputs(spark):
    df, cols = _series(spark, 300, k=3, seed=1)
    names = list(cols)
    sizes = {m: [(r["target"], len(r["coef"])) for r in fc.fit_mode(df, names, names[1], m, 2, {"f": (2, 300)}, n_rows=300).coefs.orderBy("target").collect()]
             for m in ("M", "MS", "S")}
    assert sizes == {"M": [(t, 6) for t in names], "MS": [(names[1], 6)], "S": [(names[1], 2)]}
    with pytest.raises(ValueError):
        fc.fit_mode(df, names, "other", "MS", 2, {"f": (2, 300)})
    gone = df.where("idx <> 100")
    with pytest.raises(ValueError, match="gaps"):
        fc.fit_vector(gone, names, names, 2, {"f": (2, 300)}, n_rows=300)


def test_stored_index_gives_the_same_models_and_prunes(spark):
    """Ranges of a stored index reach its scan as ranges of stamps, and nothing is collected but the solved models."""
    from rigcast.operators import lagfit
    from rigcast.operators.order import index_table, merged
    df, cols = _series(spark, 400, k=2, seed=6)
    t = index_table(df.withColumnRenamed("idx", "at"), ["at"])
    view = t.view(lambda x: x.withColumn("s0", F.col("s0") * 2))
    plan = view.between(100, 150)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_rid" in plan and "LessThanOrEqual(_rid" in plan
    assert [r.idx for r in view.ranges([(390, 500), (-5, 3), (2, 4), (7, 7)]).orderBy("idx").collect()] == [0, 1, 2, 3, *range(390, 400)]
    assert merged([(5, 7), (0, 2), (7, 9), (3, 3)]) == [(0, 2), (5, 9)]
    a = fc.fit_ar(view, ["s0", "s1"], 5, end=300).orderBy("target").collect()
    b = fc.fit_ar(df.withColumn("s0", F.col("s0") * 2), ["s0", "s1"], 5, end=300, n_rows=400).orderBy("target").collect()
    for x, y in zip(a, b):
        assert np.allclose(x["coef"], y["coef"], atol=1e-10)
    rows = lagfit.solve(view, ["s0"], [lagfit.Job("j", 5, (5, 300))])
    assert rows.columns == [c for c in lagfit._COLUMNS if c != "gap"] and rows.count() == 1


def test_proposals_beat_random_trials_on_a_fixed_surface():
    """Equal numbers of trials: the best of the adaptive ones is better in the mean, and in most of the runs."""
    def surface(look, ridge):
        return (look - 83) ** 2 / 900 + (np.log(ridge) - np.log(0.03)) ** 2 / 4

    ranges = (12, 120), (1e-4, 10.0)
    adaptive, plain = [], []
    for seed in range(30):
        rng = np.random.default_rng(seed)
        history = []
        for _ in range(10):
            history += [(a, b, surface(a, b)) for a, b in fc.propose(history, 6, rng, *ranges)]
        assert all(12 <= a <= 120 and 1e-4 * 0.999 <= b <= 10.001 for a, b, _ in history) and len(history) == 60
        adaptive.append(min(h[2] for h in history))
        plain.append(min(surface(a, b) for a, b in fc.propose([], 60, np.random.default_rng(1000 + seed), *ranges)))
    assert np.mean(adaptive) < np.mean(plain) and np.median(adaptive) < np.median(plain)


def test_adaptive_search_keeps_its_budgets(spark):
    n = 400
    df, cols = _series(spark, n, k=2, seed=2)
    ticks = iter([0.0, 5.0, 20.0, 30.0])
    tab, best = fc.adaptive_search(df, list(cols), n, 320, (2, 6), (1e-3, 1.0), budget=12, generation=4, seconds=10, clock=lambda: next(ticks))
    assert tab.select("trial").distinct().count() == 8          # the time was up after the second generation
    tab, best = fc.adaptive_search(df, list(cols), n, 320, (2, 6), (1e-3, 1.0), budget=6, generation=4)
    low = {r["target"]: r["m"] for r in tab.groupBy("target").agg(F.min("rmse").alias("m")).collect()}
    assert tab.count() == 12 and {r["target"]: r["rmse"] for r in best.collect()} == low
