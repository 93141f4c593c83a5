"""Column functions on the hand-made cases of FIXTURES.md."""

import math

import pytest
from pyspark.sql import functions as F

from rigcast.functions.names import normalise_name, normalise_names, unit_from_name
from rigcast.functions.numeric import coerce_double, hyd_power, mech_power


def test_coercion_cases(spark):
    cases = ["1.5", "abc", "NaN", "inf", " 7 ", "1e3", "", "1,000", "5f", "5d", "0x1A", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i int, s string")
    got = {r["i"]: r["v"] for r in df.select("i", coerce_double(F.col("s")).alias("v")).collect()}
    kept = {i: v for i, v in got.items() if v is not None and not math.isnan(v)}
    assert kept == {0: 1.5, 3: math.inf, 4: 7.0, 5: 1000.0}
    assert math.isnan(got[2])


def test_unit_from_file_names(spark):
    names = ["HYD000135-1_RAW.csv", "HYD123456_RAW.csv", "HYD0135RAW.csv", "hyd-0_RAW.csv",
             "HYD 000135-1_RAW.csv", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r["n"]: r["u"] for r in df.select("n", unit_from_name(F.col("n")).alias("u")).collect()}
    assert got["HYD000135-1_RAW.csv"] == 135
    assert got["HYD123456_RAW.csv"] == 3456
    assert got["HYD0135RAW.csv"] is None
    assert got["hyd-0_RAW.csv"] is None
    assert got[""] is None


def test_power_formulas(spark):
    df = spark.createDataFrame([(1500.0, 20.0, 200.0, 30.0)], "n double, t double, p double, q double")
    r = df.select(mech_power(F.col("n"), F.col("t")).alias("m"), hyd_power(F.col("p"), F.col("q")).alias("h")).first()
    assert r["m"] == 1500.0 * 20.0 * math.pi / 30 / 1e3
    assert r["h"] == 200.0 * 1e5 * 30.0 * 1e-3 / 60 / 1e3


def test_name_normalisation():
    assert normalise_name(" Vibration 2") == "VIBRATION_2"
    assert normalise_name(" Vibration 2", "keep_case") == "Vibration_2"
    assert normalise_name("M2 Amp ", "keep_case") == "M2_Amp_"
    with pytest.raises(ValueError):
        normalise_names(["a b", "A_B"])
