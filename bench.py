"""Benchmark: the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Every query is executed in full with the ``noop``
sink (no collect); ``queries`` holds the cold run (first execution in the
session), ``warm`` a second execution of the same query.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "dense_index", "coerce_dropna_step", "power_features", "standard_scale", "lookback_windows",
    "multivar_windows", "seq2seq_windows", "metric_bundle", "fold_summary", "ar_fit", "ar_cv",
    "ar_forecast", "ar_horizon", "trial_search", "var_forecast", "registry_version", "ingest_csv",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import SparkSession
    b = (SparkSession.builder.master(f"local[{cpus}]").appName("rigcast-bench")
         .config("spark.sql.shuffle.partitions", cpus)
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", os.environ.get("BENCH_MEM", "16g"))
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rigcast-bench-"))
    from rigcast.plans.catalog import QUERIES, interim, raw_folder, raw_log

    def run(name):
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.time() - t, 3)

    t0 = time.time()
    raw_log(spark, sf_dir)                   # stand-in input, not timed as a query
    shaped = round(time.time() - t0, 3)
    t0 = time.time()
    interim(spark, sf_dir)
    prep = round(time.time() - t0, 3)
    t0 = time.time()
    raw_folder(spark, sf_dir, "csv")         # stand-in input, not timed as a query
    setup = {"interim_stage": prep, "shape_standin_raw_log": shaped, "write_standin_raw_folder": round(time.time() - t0, 3)}
    cold = {"interim_stage": prep}
    for q in HEADLINE:
        cold[q] = run(q)
    warm = {q: run(q) for q in HEADLINE}
    total = round(sum(cold.values()), 3)
    print(json.dumps({"metric": "headline_total_cold", "value": total, "unit": "sec",
                      "queries": cold, "warm": warm, "warm_total": round(sum(warm.values()), 3),
                      "setup": setup,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "cores": int(cpus), "driver_memory": os.environ.get("BENCH_MEM", "16g")}))
    spark.stop()


if __name__ == "__main__":
    main()
