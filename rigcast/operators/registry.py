"""H: champion/challenger registry as table operators.

Challengers and champions are tables keyed by ``target`` (one row per target
and version), so every step is a join on that key. The registry is written to
a new location on promotion, never over the table being read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def compare_strict(challengers: DataFrame, champions: DataFrame, metric: str = "test_loss",
                   key: str = "target") -> DataFrame:
    """H1: promote when there is no champion or ``challenger < champion``.
    Adds ``champion_<metric>`` and ``promote``. A comparison with NaN on either
    side does not promote; a champion row without a value fails the job."""
    champ = champions.select(key, F.lit(True).alias("_has_champion"), F.col(metric).alias(f"champion_{metric}"))
    new, old = F.col(metric), F.col(f"champion_{metric}")
    better = (new < old) & ~F.isnan(new.cast("double")) & ~F.isnan(old.cast("double"))
    j = challengers.join(champ, key, "left")
    return j.withColumn("promote", F.when(F.col("_has_champion").isNull(), F.lit(True))
                        .when(old.isNull(), F.raise_error(F.lit(f"a champion has no {metric}")).cast("boolean"))
                        .otherwise(F.coalesce(better, F.lit(False)))).drop("_has_champion")


def compare_tolerance(challengers: DataFrame, champions: DataFrame,
                      metric: str = "root_mean_squared_error",
                      absolute_difference: float | None = 0.0, key: str = "target",
                      on_missing: str = "error") -> DataFrame:
    """H2: promote when ``challenger - champion <= |absolute_difference|`` (a
    tie promotes). The metric must exist on both sides (else ``ValueError``);
    ``None`` tolerance counts as 0. A challenger without a champion, or a
    missing metric value, fails the job (``raise_error``) as the reference
    does when the champion record is absent; ``on_missing='skip'`` leaves
    such targets out instead."""
    if on_missing not in ("error", "skip"):
        raise ValueError("on_missing must be 'error' or 'skip'")
    for side, frame in (("champion", champions), ("challenger", challengers)):
        if metric not in frame.columns:
            raise ValueError(f"{metric} is missing on the {side} side")
    tol = abs(absolute_difference or 0.0)
    champ = champions.select(key, F.lit(True).alias("_has_champion"),
                             F.col(metric).alias(f"champion_{metric}"))
    j = challengers.join(champ, key, "left" if on_missing == "error" else "inner")
    chal_v, champ_v = F.col(metric), F.col(f"champion_{metric}")
    checked = (F.when(F.col("_has_champion").isNull(),
                      F.raise_error(F.concat(F.lit("no champion metrics for "), F.col(key).cast("string"))))
               .when(chal_v.isNull() | champ_v.isNull(),
                     F.raise_error(F.lit(f"{metric} is missing for a target")))
               .otherwise(chal_v - champ_v))
    return j.withColumn("promote", checked.cast("double") <= F.lit(tol)).drop("_has_champion")


def promote(champions: DataFrame, decisions: DataFrame, key: str = "target") -> DataFrame:
    """H3: the winners replace their champions (upsert by ``key``); the other
    champions stay. ``decisions`` holds the challenger columns and ``promote``."""
    winners = decisions.where("promote").drop("promote",
                                               *[c for c in decisions.columns if c.startswith("champion_")])
    kept = champions.join(winners.select(key), key, "left_anti")
    return kept.unionByName(winners, allowMissingColumns=True)


def register_versions(registry: DataFrame, uploads: DataFrame, key: str = "target",
                      order_by: tuple[str, ...] = ("timestamp", "run_id")) -> DataFrame:
    """H4: a new name gets version 1, a known name the next version, which
    becomes the default; older versions of that name lose the flag. Several
    uploads of one name are numbered in the order of those ``order_by`` columns
    that they have, then of their other columns' hash."""
    rest = [c for c in uploads.columns if c not in (key, *order_by)]
    order = [c for c in order_by if c in uploads.columns] + [F.xxhash64(*rest or [key])]
    last = registry.groupBy(key).agg(F.max("version").alias("_last"))
    new = (uploads.join(last, key, "left")
           .withColumn("version", (F.coalesce(F.col("_last"), F.lit(0))
                                   + F.row_number().over(Window.partitionBy(key).orderBy(*order))).cast("int"))
           .drop("_last"))
    both = registry.drop("is_default").unionByName(new, allowMissingColumns=True)
    w = Window.partitionBy(key)
    return both.withColumn("is_default", F.col("version") == F.max("version").over(w))
