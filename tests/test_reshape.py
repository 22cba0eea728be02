import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import ts
from vigil.functions import safe_div, strict_number
from vigil.operators import profile as pf
from vigil.operators import reshape as rs


def test_ratio_only_at_same_time(spark):
    long = spark.createDataFrame([
        ("a", ts("2020-01-01 01:00:00"), "weight_kg", 80.0), ("a", ts("2020-01-01 02:00:00"), "height_cm", 180.0),
        ("b", ts("2020-01-01 01:00:00"), "weight_kg", 90.0), ("b", ts("2020-01-01 01:00:00"), "height_cm", 150.0),
        ("c", ts("2020-01-01 01:00:00"), "weight_kg", 70.0), ("c", ts("2020-01-01 01:00:00"), "height_cm", 0.0)],
        "id string, t timestamp_ntz, cat string, v double")
    w = rs.pivot_eav(long, keys=["id", "t"], cat="cat", value="v", categories=["weight_kg", "height_cm"])
    w = w.withColumn("bmi", safe_div(F.col("weight_kg"), (F.col("height_cm") / 100) ** 2))
    bmi = {}
    for r in w.collect():
        bmi.setdefault(r["id"], []).append(r["bmi"])
    assert bmi["a"] == [None, None]
    assert abs(bmi["b"][0] - 40.0) < 1e-9
    assert bmi["c"] == [None]


def test_strict_parse_raises(spark):
    df = spark.createDataFrame([("abc",)], "s string")
    with pytest.raises(PySparkException):
        df.select(strict_number("s")).collect()


def test_missing_category_and_all_null_column(spark):
    long = spark.createDataFrame([("a", ts("2020-01-01 01:00:00"), "hr", 80.0)], "id string, t timestamp_ntz, cat string, v double")
    w = rs.pivot_eav(long, keys=["id", "t"], cat="cat", value="v", categories=["hr", "temp"])
    assert w.columns == ["id", "t", "hr", "temp"] and w.collect()[0]["temp"] is None
    m = {r["column"]: r for r in pf.missingness(w, ["hr", "temp"]).collect()}
    assert m["temp"]["nan_percentage"] == 100.0 and m["hr"]["na_count"] == 0


def test_worst_values_ranges(spark):
    long = spark.createDataFrame([("a", 1, "creatinine", 3.0), ("a", 2, "creatinine", 25.0),
                                  ("a", 1, "platelet_count", 90.0), ("a", 2, "platelet_count", 40.0),
                                  ("b", 1, "po2_arterial", 20.0)], "id string, t int, cat string, v double")
    r = {x["id"]: x for x in rs.worst_values(long, id_col="id", t="t", cat="cat", value="v",
                                              worst_max=["creatinine"], worst_min=["platelet_count", "po2_arterial"],
                                              ranges={"creatinine": (0, 20), "platelet_count": (0, 2000),
                                                      "po2_arterial": (30, 700)}).collect()}
    assert r["a"]["creatinine_max"] == 3.0 and r["a"]["platelet_count_min"] == 40.0
    assert "b" not in r or r["b"]["po2_arterial_min"] is None


def test_describe_matches_pandas(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.RandomState(4)
    pdf = pd.DataFrame({"x": rng.rand(101), "y": rng.randint(0, 5, 101).astype(float)})
    pdf.loc[3, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(F.isnan("x"), None).otherwise(F.col("x")))
    got = {r["statistic"]: r for r in pf.transpose_stats(pf.describe(df, ["x", "y"]), ["x", "y"]).collect()}
    exp = pdf.describe()
    for stat in ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]:
        for c in ["x", "y"]:
            assert abs(got[stat][c] - exp.loc[stat, c]) < 1e-9, (stat, c)
