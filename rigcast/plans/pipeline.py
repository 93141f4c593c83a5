"""Batch pipelines as compositions of the operators.

``train_pipeline`` follows the batch DAG (ingest -> preprocess -> split ->
scale -> windows -> fit with folds -> evaluate -> registry) with the variant
differences as parameters; ``flagship`` is the minimum slice on the driver's
``events`` table. Actions happen only where documented: the dense index (one
write), the fits (one statistics job each), counts for split borders.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigcast.constants import FORECAST_FEATURES, INTERIM_FEATURES
from rigcast.operators import forecast as fc
from rigcast.operators import metrics as mt
from rigcast.operators import registry as rg
from rigcast.operators import scaling as sc
from rigcast.operators import splits as sp
from rigcast.constants import STEP_COLUMN
from rigcast.operators.clean import (add_power_features, add_running_time, coerce_all_but_time, coerce_numeric,
                                     drop_columns, drop_idle_steps, drop_missing,
                                     forecast_targets, normalise_columns, select_features, unpivot_targets)
from rigcast.operators.order import IndexedTable, IndexedView, index_table, rows_in, shaped
from rigcast.operators.windows import inference_windows
from rigcast.sources.telemetry import EVENT_ORDER, load, raw_from_events


def clean_and_index(raw: DataFrame, order: Sequence[str], features: Sequence[str] = INTERIM_FEATURES,
                    style: str = "upper") -> IndexedTable:
    """Raw text rows -> cleaned rows (B4-B15) -> dense index (B16), stored.

    Every value is parsed once for the filters and the power columns; the
    input of the range sampling is stored by ``index_table``."""
    typed = coerce_numeric(select_features(raw, features, keep=order), features)
    x = drop_columns(drop_idle_steps(drop_missing(typed, list(features))), [STEP_COLUMN])
    return index_table(normalise_columns(add_power_features(x), style, keep=order), list(order))


def preprocess(raw: DataFrame, order: Sequence[str], features: Sequence[str] = INTERIM_FEATURES,
               style: str = "upper") -> tuple[IndexedView, list[str]]:
    """Raw text rows -> interim table (R3) with ``idx`` and running time, behind
    its stored index, and the forecast targets (B15)."""
    view = clean_and_index(raw, order, features, style).view(add_running_time)
    return view, forecast_targets(view.frame().columns)


@dataclass
class TrainResult:
    params: DataFrame       # scaler parameter table
    coefs: DataFrame        # coefficient table of the kept model
    folds: DataFrame        # (target, fold, val_loss, val_rmse)
    val_summary: DataFrame  # G10
    test: DataFrame         # G11 record per target
    bundle: DataFrame       # G9 on the test windows


def train_pipeline(interim, n: int, targets: Sequence[str], lookback: int = 120,
                   folds: int = 5, train_size: float = 0.8, val_size: float | None = 0.2,
                   ridge: float | Sequence[float] = 1e-3, run_id: str = "run",
                   keep: str = "last_fold") -> TrainResult:
    """Split (C1) -> scale (D1/D2) -> CV fit (F2, C4/C5) -> test anchors inside
    the test slice, predicted block-wise (F3) -> metrics (G9-G11). ``keep='last_fold'`` ships the last
    fold's model as the batch pipeline does; ``'refit'`` refits on the whole
    training part. A ``ridge`` grid is resolved per fold on the hold-out tail
    (``val_size``)."""
    targets = list(targets)
    k = sp.split_border(n, train_size)
    wide = shaped(interim, lambda df: df.select("idx", *targets))
    params = sc.fit_standard(rows_in(wide, [(0, k)]), targets)
    p = sc.collect_params(params)
    scaled = shaped(wide, lambda df: sc.transform(df, p, targets))
    cv = fc.cross_validate(scaled, targets, lookback, k, folds, ridge, val_size)
    fold_tab = fc.fold_scores(cv)
    if keep == "last_fold":
        coefs = cv.coefs.where(F.col("fit") == f"fold{folds}")
    else:
        lam = ridge if isinstance(ridge, (int, float)) else float(
            cv.coefs.where(F.col("fit") == f"fold{folds}").agg(F.median("ridge")).first()[0])
        coefs = fc.fit_ar(scaled, targets, lookback, end=k, ridge=lam, n_rows=n)
    pred = fc.predict_blocks(scaled, k, n, coefs, targets, targets, lookback)
    return TrainResult(params, coefs, fold_tab, mt.fold_summary(fold_tab),
                       mt.test_record(pred, run_id), mt.metric_bundle(pred))


def predict_new(rows: DataFrame, coefs: DataFrame, params: dict, lookback: int, targets: Sequence[str] = FORECAST_FEATURES,
                horizon: int = 1, include_latest: bool = False) -> DataFrame:
    """new raw rows (text columns and ``_file, _block, _ord``) -> coerce all
    but time (B6) -> idle filter (B9) -> drop rows with a missing interim feature
    (B7; a column that only some layouts have decides nothing) -> power (B11-B13)
    -> index -> training scaler (D2) -> inference windows inside each file (E4;
    its newest ``horizon`` windows only with ``include_latest``) -> predict (F3)."""
    order = ["_file", "_block", "_ord"]
    x = coerce_all_but_time(rows, [c for c in rows.columns if c not in order])
    x = normalise_columns(add_power_features(drop_missing(drop_idle_steps(x), INTERIM_FEATURES)), keep=order)
    x = index_table(x, order)
    scaled = sc.transform(x.frame().select("_file", "idx", *targets), params, targets)
    long = unpivot_targets(scaled, targets, ids=("_file", "idx"))
    w = inference_windows(long, "value", lookback, x.count, include_latest=True, series=["_file", "target"])
    if not include_latest:
        last = x.frame().groupBy("_file").agg(F.max("idx").alias("_last"))
        w = w.join(last, "_file").where(F.col("end_idx") <= F.col("_last") - horizon).drop("_last")
    return fc.predict(w, coefs)


def update_registry(champions: DataFrame, result: TrainResult, rule: str = "strict",
                    tolerance: float = 0.0, on_missing: str = "error") -> DataFrame:
    """H1/H2 + H3: compare this run's test record with the champions and upsert
    the winners (with their coefficients and validation summary)."""
    chal = (result.test.join(result.val_summary, "target")
            .join(result.coefs.select("target", "lookback", "intercept", "coef"), "target"))
    if rule == "strict":
        dec = rg.compare_strict(chal, champions)
    else:
        chal = chal.withColumn("root_mean_squared_error", F.col("test_rmse"))
        dec = rg.compare_tolerance(chal, champions, absolute_difference=tolerance,
                                   on_missing=on_missing)
    return rg.promote(champions, dec)


def preprocess_folder(spark: SparkSession, folder: str, features: Sequence[str] = INTERIM_FEATURES,
                      style: str = "upper") -> tuple[IndexedView, list[str], DataFrame]:
    """Raw folder -> interim table: ingest (A1-A4, B1-B3, I2), then the
    preprocessing of :func:`preprocess` over the raw order (I1). Files missing
    a configured column cannot provide it (their rows are dropped as missing,
    as the by-name union leaves it null). Returns the interim table, the
    forecast targets and the rejects table."""
    from rigcast.operators.order import RAW_ORDER
    from rigcast.sources.files import ingest_folder
    ing = ingest_folder(spark, folder)
    rows = ing.rows
    for c in features:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    interim, targets = preprocess(rows, list(RAW_ORDER), features, style)
    return interim.view(lambda df: df.drop(*RAW_ORDER)), targets, ing.rejects


def flagship(spark: SparkSession, sf_dir: str, lookback: int = 120, folds: int = 5) -> DataFrame:
    """Minimum slice end to end on ``events``; returns the metric bundle."""
    raw = raw_from_events(load(spark, sf_dir, "events"))
    interim, targets = preprocess(raw, EVENT_ORDER)
    res = train_pipeline(interim, interim.count, [t for t in FORECAST_FEATURES if t in targets], lookback, folds)
    return res.bundle.join(res.val_summary, "target")
