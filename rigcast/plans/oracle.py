"""DuckDB oracle SQL for the registered queries.

Every statement reads the pre-registered views (``events``, ``supplier``,
``customer``, ``orders`` ...) and recomputes the query with plain SQL:
window functions over a single ORDER BY for the row index, ``list()`` frames
for windows, ``regr_*`` for the lag-1 regression. Text is generated from the
same fixed configuration the Spark side uses, so column names agree.
"""

from __future__ import annotations

from rigcast.constants import FORECAST_FEATURES, INTERIM_FEATURES, POWER_FEATURES
from rigcast.functions.names import normalise_name
from rigcast.sources.telemetry import SENSOR_SOURCE, raw_sql_columns

SENSORS = list(SENSOR_SOURCE)
NORM = {c: normalise_name(c) for c in INTERIM_FEATURES}
TARGETS = FORECAST_FEATURES

_SUFFIX = r"^\s*[+-]?[0-9.].*[fFdD]\s*$"


def qi(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def coerce(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{_SUFFIX}') THEN NULL ELSE TRY_CAST({x} AS DOUBLE) END"


def power_sql(kind: str, a: str, b: str) -> str:
    if kind == "mech":
        return f"{a} * {b} * pi() / 30.0 / 1e3"
    if kind == "abs_mech":
        return f"abs({a} * {b} * pi() / 30.0 / 1e3)"
    return f"{a} * 1e5 * {b} * 1e-3 / 60.0 / 1e3"


def r6(x: str) -> str:
    return f"round({x}, 6)"


def interim_ctes() -> str:
    """raw -> typed -> kept (not missing, step != 0) -> feat (names, power) -> interim (idx)."""
    typed = ", ".join(["ts", "event_id"] + [f"{coerce(qi(c))} AS {qi(c)}" for c in INTERIM_FEATURES])
    ok = " AND ".join(f"{qi(c)} IS NOT NULL AND NOT isnan({qi(c)})" for c in INTERIM_FEATURES)
    feat = ", ".join(["ts", "event_id"] + [f"{qi(c)} AS {NORM[c]}" for c in SENSORS]
                     + [f"{power_sql(k, qi(a), qi(b))} AS {out}" for out, k, a, b in POWER_FEATURES])
    return (f"raw AS (SELECT {raw_sql_columns()} FROM events),\n"
            f"typed AS (SELECT {typed} FROM raw),\n"
            f"kept AS (SELECT * FROM typed WHERE {ok} AND \"STEP\" <> 0),\n"
            f"feat AS (SELECT {feat} FROM kept),\n"
            "interim AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS idx FROM feat),\n"
            "nrows AS (SELECT count(*) AS n FROM interim)")


def border(frac: float) -> str:
    """``int(n * frac)`` with double arithmetic, as on the driver."""
    return f"(SELECT CAST(floor(n * CAST({frac!r} AS DOUBLE)) AS BIGINT) FROM nrows)"


def long_sql(src: str, targets=TARGETS, ids=("idx",), value="value") -> str:
    idc = ", ".join(ids)
    return " UNION ALL ".join(f"SELECT {idc}, '{t}' AS target, {t} AS {value} FROM {src}" for t in targets)


def std_params_sql(src: str, targets=TARGETS) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS feature, avg({t}) AS center, "
        f"CASE WHEN stddev_pop({t}) = 0 THEN 1.0 ELSE stddev_pop({t}) END AS scale FROM {src}"
        for t in targets)


def minmax_params_sql(src: str, targets=TARGETS) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS feature, min({t}) AS center, "
        f"CASE WHEN max({t}) - min({t}) = 0 THEN 1.0 ELSE max({t}) - min({t}) END AS scale FROM {src}"
        for t in targets)


def scaled_long_ctes(train_frac: float = 0.8) -> str:
    """Long series scaled with the training part's standard parameters."""
    return (f"train AS (SELECT * FROM interim WHERE idx < {border(train_frac)}),\n"
            f"params AS ({std_params_sql('train')}),\n"
            f"long AS ({long_sql('interim')}),\n"
            "scaled AS (SELECT l.idx, l.target, (l.value - p.center) / p.scale AS value "
            "FROM long l JOIN params p ON p.feature = l.target)")


def lag1_ctes(lookback: int = 120, src: str = "scaled") -> str:
    """Lookback windows per target with the last lagged value as the naive prediction."""
    return (f"win AS (SELECT target, idx, value AS yt, "
            f"list(value) OVER (PARTITION BY target ORDER BY idx ROWS BETWEEN {lookback} PRECEDING AND 1 PRECEDING) AS x "
            f"FROM {src}),\n"
            f"pairs AS (SELECT target, idx, yt, x[-1] AS pred FROM win WHERE len(x) = {lookback})")


def unit_sql(name: str) -> str:
    return (f"TRY_CAST(right(string_split_regex(ltrim({name}, '-/HYDhyd0'), '[_-]')[1], 4) AS INTEGER)")


def lag2_ctes(src: str = "scaled", by: str = "target") -> str:
    """Every row with its last value ``x1`` and the one before, ``x2``."""
    return (f"lp AS (SELECT target, idx, value AS y, lag(value) OVER (PARTITION BY {by} ORDER BY idx) AS x1, "
            f"lag(value, 2) OVER (PARTITION BY {by} ORDER BY idx) AS x2 FROM {src})")


def ridge1(name: str, rows: str, ridge: float, group: str = "target", src: str = "lp") -> str:
    """Ridge regression of ``y`` on ``x1``: ``(group, icpt, newer, older = 0)``."""
    return (f"{name} AS (SELECT {group}, my - newer * m1 AS icpt, newer, 0.0 AS older FROM (SELECT {group}, "
            f"n * c1y / (n * v1 + {ridge!r}) AS newer, my, m1 FROM (SELECT {group}, count(*) AS n, covar_pop(y, x1) AS c1y, "
            f"var_pop(x1) AS v1, avg(y) AS my, avg(x1) AS m1 FROM {src} WHERE {rows} GROUP BY {group})))")


def ridge2(name: str, rows: str, ridge: float, group: str = "target", src: str = "lp") -> str:
    """Ridge regression of ``y`` on ``x1, x2`` by Cramer's rule: ``(group, n, icpt, newer, older)``."""
    return (f"{name} AS (SELECT {group}, n, my - newer * m1 - older * m2 AS icpt, newer, older FROM (SELECT {group}, n, my, m1, m2, "
            "(s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS newer, "
            f"(s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS older FROM (SELECT {group}, count(*) AS n, "
            f"count(*) * var_pop(x1) + {ridge!r} AS s11, count(*) * var_pop(x2) + {ridge!r} AS s22, "
            "count(*) * covar_pop(x1, x2) AS s12, count(*) * covar_pop(y, x1) AS s1y, count(*) * covar_pop(y, x2) AS s2y, "
            f"avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2 FROM {src} WHERE {rows} GROUP BY {group})))")


def small_forecasts(base: str, scaled: str, tfolds: str, k: str, pred_len: int, trials: list, targets) -> dict[str, str]:
    """Closed forms of the forecaster at lookbacks 1 and 2."""
    def ctes(*parts):
        return "WITH " + ",\n".join((base, scaled, lag2_ctes(), *parts)) + "\n"
    ar2 = ridge2("ar2", f"idx >= 2 AND idx < {k}", 1.0)
    rel = "CASE WHEN y <> 0 THEN (p - y) / y END"
    out = {"ar2_fit": ctes(ar2) + "SELECT target, n, round(icpt, 6) AS intercept, round(older, 6) AS older, round(newer, 6) AS newer FROM ar2"}
    out["ar2_forecast"] = ctes(ar2, "sc AS (SELECT lp.target, y, icpt + newer * x1 + older * x2 AS p FROM lp "
                               f"JOIN ar2 ON ar2.target = lp.target WHERE idx >= {k} + 2)") + (
        "SELECT target, round(avg(abs(p - y)), 6) AS mae, round(avg(power(p - y, 2)), 6) AS mse, "
        f"round(sqrt(avg(power(p - y, 2))), 6) AS rmse, round(avg(abs({rel})), 6) AS mape, "
        f"round(avg(power({rel}, 2)), 6) AS mspe FROM sc GROUP BY target")
    out["ar1_cv"] = ctes(tfolds, "ff AS (SELECT lp.*, fold, vs, ve FROM lp JOIN tfolds ON idx < ve)",
                         ridge1("fits", "idx >= 1 AND idx < vs", 0.0, "target, fold", "ff"),
                         "pf AS (SELECT ff.target, ff.fold, avg(power(icpt + newer * x1 - y, 2)) AS l FROM ff JOIN fits "
                         "ON fits.target = ff.target AND fits.fold = ff.fold WHERE idx > vs GROUP BY 1, 2)") + (
        "SELECT target, round(avg(l), 6) AS val_loss_mean, round(stddev_pop(l), 6) AS val_loss_std, "
        "round(avg(sqrt(l)), 6) AS val_rmse_mean, round(stddev_pop(sqrt(l)), 6) AS val_rmse_std FROM pf GROUP BY target")
    steps = (f"hp AS (SELECT a.target, a.idx, a.x1, CAST(h AS BIGINT) AS h, b.value AS y FROM lp a, range(1, {pred_len} + 1) r(h), "
             "scaled b WHERE b.target = a.target AND b.idx = a.idx + h - 1)")
    out["ar1_horizon"] = ctes(steps, ridge1("fits", f"idx >= 1 AND idx < {k} - {pred_len} + 1", 0.0, "target, h", "hp")) + (
        "SELECT hp.target, hp.h, round(sqrt(avg(power(icpt + newer * x1 - y, 2))), 6) AS rmse, count(*) AS n FROM hp "
        f"JOIN fits ON fits.target = hp.target AND fits.h = hp.h WHERE idx > {k} AND idx <= (SELECT n FROM nrows) - {pred_len} GROUP BY 1, 2")
    vb = f"CAST(floor({k} * CAST({1 - 0.1!r} AS DOUBLE)) AS BIGINT)"
    fits = [(ridge1 if look == 1 else ridge2)(f"t{i}", f"idx >= {look} AND idx < {vb}", ridge) for i, look, ridge in trials]
    scores = " UNION ALL ".join(
        f"SELECT lp.target, CAST({i} AS BIGINT) AS trial, sqrt(avg(power(icpt + newer * x1 + older * coalesce(x2, 0.0) - y, 2))) AS r FROM lp "
        f"JOIN t{i} ON t{i}.target = lp.target WHERE idx >= {vb} + {look} AND idx < {k} GROUP BY lp.target" for i, look, _ in trials)
    out["small_trials"] = ctes(*fits, f"sc AS ({scores})") + (
        "SELECT target, trial, round(r, 6) AS rmse, r = min(r) OVER (PARTITION BY target) AS chosen FROM sc")
    return out


def new_rows_ctes() -> str:
    """Scaled lookback-2 windows inside each stand-in file; ``view`` files lack one interim column."""
    typed = ", ".join(["name", "ts", "event_id"] + [f"{coerce(qi(c))} AS {qi(c)}" for c in INTERIM_FEATURES])
    ok = " AND ".join(f"{qi(c)} IS NOT NULL AND NOT isnan({qi(c)})" for c in INTERIM_FEATURES)
    feat = ", ".join(["name", "ts", "event_id"] + [f"{qi(c)} AS {NORM[c]}" for c in SENSORS]
                     + [f"{power_sql(k, qi(a), qi(b))} AS {out}" for out, k, a, b in POWER_FEATURES])
    long = " UNION ALL ".join(f"SELECT name, ts, event_id, '{t}' AS target, {t} AS v FROM newf" for t in TARGETS)
    return (f"newr AS (SELECT name, {raw_sql_columns()} FROM u WHERE unit IS NOT NULL AND event_type <> 'view'),\n"
            f"newt AS (SELECT {typed} FROM newr),\n"
            f"newf AS (SELECT {feat} FROM newt WHERE {ok} AND \"STEP\" <> 0),\n"
            f"newl AS ({long}),\n"
            "news AS (SELECT name, ts, event_id, l.target, (v - center) / scale AS v FROM newl l JOIN params p ON p.feature = l.target),\n"
            "neww AS (SELECT target, v AS x1, lag(v) OVER (PARTITION BY name, target ORDER BY ts, event_id) AS x2 FROM news)")


def mode_forecasts(base: str, scaled: str, k: str, pair: tuple[str, str], steps: int, kept: int) -> dict[str, str]:
    """Modes M, MS and S at lookback 1 with two series: each regressed on the last value of both (M, MS) or of itself (S)."""
    a, b = pair
    both = ("ab AS (SELECT x.idx, x.value AS va, y.value AS vb, lag(x.value) OVER (ORDER BY x.idx) AS x1, lag(y.value) OVER (ORDER BY x.idx) AS x2 "
            f"FROM scaled x JOIN scaled y ON x.idx = y.idx WHERE x.target = '{a}' AND y.target = '{b}')")
    each = (f"ml AS (SELECT '{a}' AS target, idx, va AS y, x1, x2 FROM ab UNION ALL SELECT '{b}', idx, vb, x1, x2 FROM ab),\n"
            f"own AS (SELECT '{b}' AS target, idx, vb AS y, x2 AS x1 FROM ab)")
    models = (ridge2("mb", f"idx >= 1 AND idx < {k}", 1.0, src="ml") + ",\n" + ridge1("mo", f"idx >= 1 AND idx < {k}", 1.0, src="own"))
    modes = (f"md AS (SELECT 'M' AS mode, target, n, icpt, newer AS first, older AS second FROM mb UNION ALL SELECT 'MS', target, n, icpt, newer, older FROM mb "
             f"WHERE target = '{b}' UNION ALL SELECT 'S', target, {k} - 1, icpt, CAST(NULL AS DOUBLE), newer FROM mo)")
    head = "WITH " + ",\n".join((base, scaled, both, each, models, modes)) + "\n"
    err = "(icpt + coalesce(first * x1, 0.0) + second * x2 - y)"
    out = {"mode_fit": head + "SELECT mode, target, CAST(n AS BIGINT) AS n, round(icpt, 6) AS intercept, round(first, 6) AS first, round(second, 6) AS second FROM md",
           "mode_forecast": head + f"SELECT mode, ml.target, count(*) AS n, round(avg(abs({err})), 6) AS mae, round(sqrt(avg(power({err}, 2))), 6) AS rmse "
                                   f"FROM md JOIN ml ON md.target = ml.target WHERE idx > {k} GROUP BY 1, 2"}
    far = (f"hl AS (SELECT p.target, p.idx, p.x1, p.x2, CAST(h AS BIGINT) AS h, q.y FROM ml p, range(1, {steps} + 1) r(h), ml q "
           "WHERE q.target = p.target AND q.idx = p.idx + h - 1)")
    fits = ridge2("hb", f"idx >= 1 AND idx < {k} - {steps} + 1", 1.0, "target, h", "hl")
    out["mode_horizon"] = "WITH " + ",\n".join((base, scaled, both, each, far, fits)) + (
        f"\nSELECT mode, hl.target, hl.h, count(*) AS n, round(sqrt(avg(power(icpt + newer * x1 + older * x2 - y, 2))), 6) AS rmse FROM hl "
        f"JOIN hb ON hb.target = hl.target AND hb.h = hl.h JOIN (VALUES ('M', '{a}'), ('M', '{b}'), ('MS', '{b}')) m(mode, target) ON m.target = hl.target "
        f"WHERE idx > {k} AND idx <= (SELECT n FROM nrows) - {steps} AND hl.h > {steps} - {kept} GROUP BY 1, 2, 3")
    return out


def shuffle_ctes(src: str, rounds: int = 4) -> str:
    """``rk``: rows of ``src(target, exp, seed, idx, ..)`` with their place ``p`` in the shuffled order of their series:
    a Feistel network over ``left = x % a``, ``right = x // a``, repeated while it leaves ``0 .. n - 1``."""
    left, right = "(x % a)", "(x // a)"
    for j in range(rounds):
        mixed = f"CAST('0x' || substr(md5(concat_ws(':', seed, target, exp, '{j}', {right})), 1, 8) AS BIGINT)"
        left, right = right, f"(({left} + {mixed}) % {'a' if j % 2 == 0 else 'b'})"
    return (f"sized AS (SELECT *, count(*) OVER s AS n, idx - min(idx) OVER s AS x FROM {src} WINDOW s AS (PARTITION BY target, exp)),\n"
            "roots AS (SELECT *, CAST(ceil(sqrt(n)) AS BIGINT) AS a, CAST(ceil(n / CAST(ceil(sqrt(n)) AS BIGINT)) AS BIGINT) AS b FROM sized),\n"
            "walk AS (SELECT *, 0 AS step FROM roots UNION ALL "
            f"SELECT * REPLACE (a * {right} + {left} AS x, step + 1 AS step) FROM walk WHERE step = 0 OR x >= n),\n"
            "rk AS (SELECT *, x AS p FROM walk WHERE step > 0 AND x < n)")


def new_files_sql(base: str, scaled: str, k: str, lookback: int) -> str:
    """Predictions for every new file (one per event type) from windows of ``lookback`` rows that end before its last row."""
    typed = ", ".join(["name", "ts", "event_id"] + [f"{coerce(qi(c))} AS {qi(c)}" for c in INTERIM_FEATURES])
    ok = " AND ".join(f"{qi(c)} IS NOT NULL AND NOT isnan({qi(c)})" for c in INTERIM_FEATURES)
    feat = ", ".join(["name", "ts", "event_id"] + [f"{qi(c)} AS {NORM[c]}" for c in SENSORS]
                     + [f"{power_sql(kind, qi(a), qi(b))} AS {out}" for out, kind, a, b in POWER_FEATURES])
    long = " UNION ALL ".join(f"SELECT name, ts, event_id, '{t}' AS target, {t} AS v FROM newf" for t in TARGETS)
    return "WITH " + ",\n".join((base, scaled, lag2_ctes(), ridge2("ar2", f"idx >= 2 AND idx < {k}", 1.0), (
        f"newr AS (SELECT event_type AS name, {raw_sql_columns()} FROM events),\n"
        f"newt AS (SELECT {typed} FROM newr),\nnewf AS (SELECT {feat} FROM newt WHERE {ok} AND \"STEP\" <> 0),\nnewl AS ({long}),\n"
        "neww AS (SELECT name, l.target, (v - center) / scale AS x1, lag((v - center) / scale) OVER s AS x2, row_number() OVER s AS r, "
        "count(*) OVER (PARTITION BY name, l.target) AS n FROM newl l JOIN params p ON p.feature = l.target "
        "WINDOW s AS (PARTITION BY name, l.target ORDER BY ts, event_id))"))) + (
        "\nSELECT name, w.target, count(*) AS n, round(avg(icpt + older * x2 + newer * x1), 6) AS avg_pred FROM neww w "
        f"JOIN ar2 ON ar2.target = w.target WHERE r >= {lookback} AND r < w.n GROUP BY 1, 2")
