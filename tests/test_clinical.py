import math

from conftest import ts
from vigil.functions import fixed, pao2_from_spo2
from vigil.operators import clinical as cl


def test_unit_table_has_36_pairs():
    rows = fixed.dose_factor_rows()
    assert len(rows) == 36 and len({(d, u) for d, u, *_ in rows}) == 36


def test_convert_doses(spark):
    df = spark.createDataFrame([
        ("norepinephrine", "mcg/kg/min", 0.1, 80.0), ("norepinephrine", "MCG/MIN", 8.0, 80.0),
        ("norepinephrine", "mcg/min", 8.0, None), ("vasopressin", "milliunits/min", 40.0, None),
        ("angiotensin", "mcg/kg/min", 5.0, 70.0), ("dopamine", "mg/hr", 60.0, 100.0),
        ("dopamine", "mg/hr", None, 100.0)],
        "med_category string, med_dose_unit string, med_dose double, weight_kg double")
    r = [x["med_dose_converted"] for x in cl.convert_doses(df).collect()]
    assert r == [0.1, 0.1, None, 0.04, None, 10.0]   # NULL dose row dropped


def test_dose_summary_zero_and_missing(spark):
    conv = spark.createDataFrame([("e1", "dopamine", 0.0), ("e1", "dopamine", 0.0), ("e2", "dopamine", 4.0),
                                  ("e3", "dopamine", 6.0), ("e2", "milrinone", 1.0)],
                                 "hid string, med_category string, med_dose_converted double")
    total = spark.createDataFrame([(10,)], "n_total long")
    r = {x["med_category"]: x for x in cl.dose_summary(conv, total, id_col="hid").collect()}
    assert r["dopamine"]["n_encounters"] == 3 and r["dopamine"]["overall_median_dose"] == 5.0
    assert r["dopamine"]["pct_encounters"] == 30.0
    assert r["epinephrine"]["n_encounters"] is None and len(r) == 8


def test_clean_settings(spark):
    pct = spark.createDataFrame([(50.0, 5.0), (21.0, 31.0), (0.2, 10.0)], "fio2_set double, peep_set double")
    r = cl.clean_settings(pct).collect()
    assert [x["fio2_set"] for x in r] == [0.5, 0.21, None] and [x["peep_set"] for x in r] == [5.0, None, 10.0]
    frac = spark.createDataFrame([(0.5, 5.0), (0.2, 1.0)], "fio2_set double, peep_set double")
    assert [x["fio2_set"] for x in cl.clean_settings(frac).collect()] == [0.5, None]


def test_pao2_guard(spark):
    df = spark.createDataFrame([(96.0,), (97.0,), (100.0,), (None,)], "s double")
    r = [x[0] for x in df.select(pao2_from_spo2("s")).collect()]
    assert r[0] is not None and 80 < r[0] < 90 and r[1:] == [None, None, None]


def test_initial_modes(spark):
    resp = spark.createDataFrame([
        ("a", ts("2020-01-01 00:00:00"), "IMV", " "), ("a", ts("2020-01-01 01:00:00"), "IMV", "simv"),
        ("b", ts("2020-01-01 00:00:00"), "IMV", "Made Up"), ("c", ts("2020-01-01 00:00:00"), "IMV", None),
        ("d", ts("2020-01-01 00:00:00"), "NIPPV", "SIMV")],
        "hid string, recorded_dttm timestamp_ntz, device_category string, mode_category string")
    enc = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "hid string")
    r = {(x["denominator"], x["mode_category"]): x for x in cl.initial_modes(resp, enc, id_col="hid").collect()}
    assert r[("ventilated", "SIMV")]["n_encounters"] == 1
    assert r[("ventilated", "No mode documented")]["n_encounters"] == 2
    assert r[("ventilated", "Total")]["n_encounters"] == 3 and abs(r[("ventilated", "Total")]["pct_encounters"] - 100) < 1e-9
    assert r[("all", "SIMV")]["pct_encounters"] == 25.0


def test_sofa_bands(spark):
    cols = ["dopamine", "epinephrine", "norepinephrine", "dobutamine", "map_min", "platelet_count_min",
            "bilirubin_total_max", "creatinine_max", "p_f", "p_f_imputed", "min_gcs_score"]
    rows = [
        (None,) * 11,
        (15.1, None, None, None, None, 19.9, 12.0, 5.0, 99.0, None, 5.0),
        (15.0, None, None, None, None, 20.0, 11.9, 4.9, 99.0, None, 6.0),
        (None, None, None, 0.5, 69.9, 149.9, 1.2, 1.2, 399.0, None, 14.0),
        (None, 0.1, None, None, 70.0, 150.0, 1.19, 1.19, 400.0, None, 15.0),
    ]
    import pyspark.sql.functions as F
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).withColumn(
        "resp_support_max", F.lit("Vent"))
    r = df.withColumns(cl.sofa_components()).collect()
    assert [x["sofa_cv_97"] for x in r] == [0, 4, 3, 2, 3]
    assert [x["sofa_coag"] for x in r] == [0, 4, 3, 1, 0]
    assert [x["sofa_liver"] for x in r] == [0, 4, 3, 1, 0]
    assert [x["sofa_renal"] for x in r] == [0, 4, 3, 1, 0]
    assert [x["sofa_resp_pf"] for x in r] == [0, 4, 4, 1, 0]
    assert [x["sofa_cns"] for x in r] == [0, 4, 3, 1, 0]


def test_device_imputation(spark):
    import pyspark.sql.functions as F
    df = spark.createDataFrame([
        (None, "SIMV", None, None, None, None), (None, None, 0.21, None, None, None),
        (None, None, None, 0.0, None, None), (None, None, None, 4.0, None, None),
        (None, None, None, 30.0, None, None), ("Nasal Cannula", None, None, 30.0, None, None)],
        "device_category string, mode_category string, fio2_set double, lpm_set double, peep_set double, tidal_volume_set double")
    r = df.withColumn("d", cl.impute_device()).withColumn("device_category", F.col("d")).withColumn(
        "f", cl.impute_fio2()).collect()
    assert [x["d"] for x in r] == ["Vent", "Room Air", "Room Air", "Nasal Cannula", "High Flow NC", "High Flow NC"]
    assert math.isclose(r[3]["f"], 0.4) and r[1]["f"] == 0.21
