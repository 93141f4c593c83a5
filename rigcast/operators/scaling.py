"""D: scalers as parameter tables.

A fit is one aggregation pass (partial aggregates per task, one tiny final
merge) that yields a parameter table ``(feature, kind, center, scale)``: one
row per column, so it is bounded by the schema and is safe to broadcast or to
inline as literals. Transform, inverse and long-form application are plain
projections.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigcast.operators.clean import col

PARAM_SCHEMA = "feature string, kind string, center double, scale double"


def _params_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, PARAM_SCHEMA)


def fit_standard(df: DataFrame, columns: Sequence[str], zero_std: str = "one") -> DataFrame:
    """Mean and population standard deviation per column.

    ``zero_std='one'`` replaces a zero deviation by 1 (D1); ``'zero'`` keeps
    it, so transforming gives NaN/inf as plain division would (D3)."""
    if zero_std not in ("one", "zero"):
        raise ValueError("zero_std must be 'one' or 'zero'")
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.avg(col(c)).alias(f"m{i}"), F.stddev_pop(col(c)).alias(f"s{i}")]
    wide = df.agg(*aggs)
    parts = [F.struct(F.lit(c).alias("feature"), F.lit("standard").alias("kind"),
                      F.col(f"m{i}").alias("center"),
                      (F.when(F.col(f"s{i}") == 0, F.lit(1.0)).otherwise(F.col(f"s{i}"))
                       if zero_std == "one" else F.col(f"s{i}")).alias("scale"))
             for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*parts)))


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(x - min) / (max - min)``; a zero range divides by 1, so a
    constant column maps to 0."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.min(col(c)).alias(f"lo{i}"), F.max(col(c)).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    parts = []
    for i, c in enumerate(columns):
        rng = F.col(f"hi{i}") - F.col(f"lo{i}")
        parts.append(F.struct(F.lit(c).alias("feature"), F.lit("minmax").alias("kind"),
                              F.col(f"lo{i}").alias("center"),
                              F.when(rng == 0, F.lit(1.0)).otherwise(rng).alias("scale")))
    return wide.select(F.inline(F.array(*parts)))


def fit_minmax_long(df: DataFrame, by: str = "target", value: str = "value") -> DataFrame:
    """D5 on long data: one min/max pair per target (a grouped aggregate)."""
    rng = F.max(value) - F.min(value)
    return df.groupBy(F.col(by).alias("feature")).agg(
        F.lit("minmax").alias("kind"), F.min(value).alias("center"),
        F.when(rng == 0, F.lit(1.0)).otherwise(rng).alias("scale"))


def collect_params(params: DataFrame) -> dict[str, tuple[float, float]]:
    """Parameter table -> ``{feature: (center, scale)}`` (one row per column)."""
    return {r["feature"]: (r["center"], r["scale"]) for r in params.collect()}


def _divide(num, den):
    """``num / den`` with IEEE results for a zero divisor (ANSI division raises)."""
    return (F.when(den != 0, num / den)
            .when(num == 0, F.lit(float("nan")))
            .otherwise(F.signum(num) * F.lit(float("inf"))))


def transform(df: DataFrame, params: DataFrame | dict, columns: Sequence[str] | None = None) -> DataFrame:
    """``(x - center) / scale`` for every fitted column (test data uses the
    training parameters). Parameters become literals: a pure projection."""
    p = collect_params(params) if isinstance(params, DataFrame) else params
    cols = [c for c in (columns or p.keys()) if c in df.columns]
    return df.withColumns({c: _divide(col(c) - F.lit(p[c][0]), F.lit(p[c][1])) for c in cols})


def inverse_transform(df: DataFrame, params: DataFrame | dict, columns: Sequence[str] | None = None) -> DataFrame:
    """``x * scale + center``, parameters picked by feature name."""
    p = collect_params(params) if isinstance(params, DataFrame) else params
    cols = [c for c in (columns or p.keys()) if c in df.columns]
    return df.withColumns({c: col(c) * F.lit(p[c][1]) + F.lit(p[c][0]) for c in cols})


def transform_long(df: DataFrame, params: DataFrame, by: str = "target", value: str = "value") -> DataFrame:
    """D2 on long data: join the (schema-bounded) parameter table on the key."""
    p = F.broadcast(params.select(F.col("feature").alias(by), "center", "scale"))
    out = df.join(p, by).withColumn(value, _divide(F.col(value) - F.col("center"), F.col("scale")))
    return out.drop("center", "scale")


def first_rows(part: DataFrame, n: int, idx: str = "idx") -> DataFrame:
    """The first ``n`` rows of a part with a dense index."""
    low = part.agg(F.min(idx)).first()[0]
    return part if low is None else part.where(F.col(idx) < low + n)


def fit_transform(train: DataFrame, others: dict[str, DataFrame], columns: Sequence[str],
                  kind: str = "standard", fit_on: str = "train", zero_std: str = "one",
                  fit_rows: int | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Fit scope. ``fit_on='train'`` scales every part with the training
    parameters; ``'own_part'`` fits each part on itself. ``fit_rows`` fits on
    the first so many rows of a part (by ``idx``) and still scales all of it.
    Columns left out of ``columns`` (an unscaled target) stay as they are."""
    def fit(d):
        d = d if fit_rows is None else first_rows(d, fit_rows)
        return fit_standard(d, columns, zero_std) if kind == "standard" else fit_minmax(d, columns)
    params = fit(train)
    p = collect_params(params)
    out = {"train": transform(train, p, columns)}
    for name, part in others.items():
        out[name] = transform(part, p if fit_on == "train" else collect_params(fit(part)), columns)
    return params, out
