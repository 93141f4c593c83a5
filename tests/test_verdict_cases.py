"""Gaps, long headers, NaN champions, reruns and ties."""

import os

import pytest
from pyspark.sql import functions as F

from rigcast.operators import forecast as fc
from rigcast.operators import registry as rg
from rigcast.sources import files as fl


def _series(spark, n, gone):
    return spark.range(n).where(~F.col("id").isin(list(gone))).select(F.col("id").alias("idx"), (5 + F.sin("id")).alias("y"))


@pytest.mark.parametrize("missing", [1, 30, 60])
@pytest.mark.parametrize("start", [100, 215])
def test_gaps_raise(spark, missing, start):
    df = _series(spark, 400, range(start, start + missing))
    with pytest.raises(ValueError, match="gaps"):
        fc.fit_ranges(df, ["y"], 60, {"full": (60, 200)}, {"full": {"test": (260, 400)}}, n_rows=400)


def test_gap_between_lookback_and_start_raises(spark):
    with pytest.raises(ValueError, match="gaps"):
        fc.fit_ranges(_series(spark, 400, [70]), ["y"], 60, {"full": (100, 300)}, n_rows=400)


def test_dense_series_fits(spark):
    out = fc.fit_ranges(_series(spark, 400, []), ["y"], 60, {"full": (60, 300)}, {"full": {"test": (300, 398)}}, n_rows=400, horizon=3)
    assert out.coefs.count() == 3


def test_strict_comparison_with_nan_and_missing(spark):
    chal = spark.createDataFrame([("a", 0.5), ("b", 0.5), ("c", float("nan")), ("d", 0.4)], "target string, test_loss double")
    champ = spark.createDataFrame([("a", float("nan")), ("c", 0.5), ("d", 0.5)], "target string, test_loss double")
    got = {r.target: r.promote for r in rg.compare_strict(chal, champ).collect()}
    assert got == {"a": False, "b": True, "c": False, "d": True}
    empty = spark.createDataFrame([("a", None)], "target string, test_loss double")
    with pytest.raises(Exception, match="champion has no"):
        rg.compare_strict(chal, empty).collect()


def test_rerun_replaces_its_run(spark, tmp_dir):
    path = os.path.join(tmp_dir, "metrics")
    def rows(v, run):
        return spark.createDataFrame([("a", run, "rmse", v)], fl.METRICS_SCHEMA)
    fl.write_metrics(rows(1.0, "r1"), path)
    fl.write_metrics(rows(2.0, "r2"), path)
    fl.write_metrics(rows(3.0, "r1"), path)
    assert sorted((r.run_id, r.value) for r in fl.read_metrics(spark, path).collect()) == [("r1", 3.0), ("r2", 2.0)]


def test_uploads_of_one_name_are_numbered_by_run(spark):
    reg = spark.createDataFrame([("a", "r0", 1, True)], "target string, run_id string, version int, is_default boolean")
    up = spark.createDataFrame([("a", "r2"), ("a", "r1")], "target string, run_id string")
    got = {r.run_id: (r.version, r.is_default) for r in rg.register_versions(reg, up).collect()}
    assert got == {"r0": (1, False), "r1": (2, False), "r2": (3, True)}


def test_header_above_16_mib_is_whole(tmp_dir):
    path = os.path.join(tmp_dir, "long.csv")
    head = ",".join(f"column_number_{i:09d}" for i in range(760_000))
    assert len(head) > 1 << 24
    with open(path, "w") as f:
        f.write(head + "\n1\n")
    assert fl._header_row(path) == head.split(",")


def test_folder_name_with_brackets(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "raw[1]")
    os.makedirs(folder)
    with open(os.path.join(folder, "HYD000135-1_RAW.csv"), "w") as f:
        f.write("A\n1\n")
    assert [r.name for r in fl.file_manifest(spark, folder).collect()] == ["HYD000135-1_RAW.csv"]


def test_csv_blank_lines_and_quoted_breaks(spark, tmp_path):
    (tmp_path / "HYD000101-a_RAW.csv").write_bytes(b'\n\nA,"B\nC"\n1,"x\ny"\n\n2,z\n')
    (tmp_path / "HYD000102-a_RAW.csv").write_bytes(b"\n\nA,D\n3,4\n")
    ing = fl.ingest_folder(spark, str(tmp_path), line_breaks=True)
    assert ing.rejects.count() == 0
    got = sorted((r["A"], r["B\nC"], r["D"]) for r in ing.rows.collect())
    assert got == [("1", "x\ny", None), ("2", "z", None), ("3", None, "4")]
    (tmp_path / "HYD000103-a_RAW.csv").write_bytes(b"\n  \r\nA,E\n5,6\n")
    plain = fl.ingest_folder(spark, str(tmp_path)).rows.where("TEST = 1 and UNIT = 103").collect()
    assert [(r["A"], r["E"]) for r in plain] == [("5", "6")]
    one = fl.scan_new_data(spark, str(tmp_path / "HYD000102-a_RAW.csv"))
    assert [(r["A"], r["D"]) for r in one.collect()] == [("3", "4")]


def test_shuffled_batches_stay_in_their_series(spark):
    from rigcast.operators import windows as wn
    w = spark.range(95).select((F.col("id") % 2).alias("s"), (F.col("id") / 2).cast("long").alias("idx"))
    got = wn.shuffled_batches(w, 10, seed=3, series=["s"]).collect()
    assert len(got) == 80 and {(r.s, r.batch_id) for r in got} == {(s, b) for s in (0, 1) for b in range(4)}


def test_fit_on_first_rows(spark):
    from rigcast.operators import scaling as sc
    df = spark.range(10, 20).select(F.col("id").alias("idx"), F.col("id").cast("double").alias("x"))
    params, _ = sc.fit_transform(df, {}, ["x"], fit_rows=4)
    assert params.first()["center"] == 11.5
