"""Session and scratch-storage helpers.

Stage outputs that must survive executor loss (the two-phase index, fitted
statistics) are written as Parquet under the folder the cluster names in
``spark.checkpoint.dir``. That setting is read from the session; a private
temporary folder is only created when it is unset *and* Spark runs in local
mode (tests, notebooks). On a cluster an unset value is an error, because a
machine-local folder is not visible to other executors.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", app: str = "rigcast",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """A session configured the way the library expects (AQE on, UTC, Arrow, no UI)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only in local mode."""
    path = spark.conf.get(_CKPT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not _is_local(spark):
            raise RuntimeError(
                f"{_CKPT_KEY} is not set; point it at a folder every executor can reach")
        path = tempfile.mkdtemp(prefix="rigcast-ckpt-")
        spark.conf.set(_CKPT_KEY, path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "rigcast-stages", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts lineage: later jobs read the stored columns and never recompute
    non-deterministic expressions (range sampling, monotonically_increasing_id).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
