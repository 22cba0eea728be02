"""End-to-end: registry-shaped tables (derived from the driver's data and written to a
scratch folder) through the configured study composition."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from vigil.plans.analogues import Analogue
from vigil.plans import registry as reg

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    root = tempfile.mkdtemp(prefix="vigil-registry-")
    a = Analogue(spark, D)
    e = a.table("events")
    vit_map = F.create_map(*[F.lit(x) for kv in {"view": "weight_kg", "click": "heart_rate", "error": "sbp",
                                                  "signup": "dbp", "purchase": "temp_c"}.items() for x in kv])
    vit = e.select(F.col("user_id").cast("string").alias("hospitalization_id"), F.col("ts").alias("recorded_dttm"),
                   vit_map[F.col("event_type")].alias("vital_category"), F.col("value").cast("string").alias("vital_value"))
    height = (e.where("event_type = 'view'").select(F.col("user_id").cast("string").alias("hospitalization_id"),
                                                   F.col("ts").alias("recorded_dttm"), F.lit("height_cm").alias("vital_category"),
                                                   (F.col("value") % 50 + 150).cast("string").alias("vital_value")))
    spo2 = (e.where("event_type = 'click'").select(F.col("user_id").cast("string").alias("hospitalization_id"),
                                                  F.col("ts").alias("recorded_dttm"), F.lit("spo2").alias("vital_category"),
                                                  (F.col("value") % 40 + 60).cast("string").alias("vital_value")))
    cats = F.array(*[F.lit(c) for c in reg.LAB_CATEGORIES])
    labs = e.select(F.col("user_id").cast("string").alias("hospitalization_id"), F.col("ts").alias("lab_order_dttm"),
                    F.element_at(cats, (F.col("event_id") % 18 + 1).cast("int")).alias("lab_category"),
                    F.when(F.col("event_id") % 17 == 0, F.concat(F.lit(">"), F.col("value").cast("string")))
                    .otherwise(F.col("value").cast("string")).alias("lab_value"),
                    F.col("value").alias("lab_value_numeric"))
    li = a.table("lineitem")
    rsup = a.settings().withColumn("hospitalization_id", (F.col("hospitalization_id").cast("long") % 150).cast("string")) \
        .withColumn("recorded_dttm", F.lit("2024-01-01").cast("timestamp_ntz")
                    + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("l_linenumber") * 97 % 1440).cast("int")))
    gcs = e.where("event_type = 'error'").select(F.col("user_id").cast("string").alias("hospitalization_id"),
                                                 F.col("ts").alias("recorded_dttm"), F.lit("gcs_total").alias("assessment_category"),
                                                 (F.col("value") % 13 + 3).alias("numerical_value"))
    out = {"adt": a.stays().drop("event_id"), "hospitalization": a.encounters(), "patient": a.patients(),
           "vitals": vit.unionByName(height).unionByName(spo2), "labs": labs,
           "respiratory_support": rsup.drop("l_linenumber"), "medication_admin_continuous": a.doses().drop("event_id"),
           "patient_assessments": gcs}
    for k, v in out.items():
        v.write.parquet(os.path.join(root, f"{k}.parquet"))
    del li
    return reg.load_registry(spark, root)


RULES = dict(admit_from="2024-01-01", admit_before="2025-01-01")


def test_model_matrix(spark, tables):
    c = reg.study_cohort(tables, **RULES)
    m = reg.model_matrix(c, tables)
    assert m.columns[5:] == reg.model_columns() and len(reg.model_columns()) == 74
    assert m.count() == c.count() > 0


def test_evaluation_and_descriptive(spark, tables):
    c = reg.study_cohort(tables, **RULES)
    m = reg.model_matrix(c, tables)
    scored = m.withColumn("pred_proba", F.abs(F.hash("hospitalization_id")) % 1000 / 1000.0).withColumn("site", F.lit("X"))
    out = reg.evaluation(scored, replicates=50)
    assert out["metrics"].count() == 5 and out["top_n"].count() == 100
    assert out["roc"].count() >= 2 and out["pr"].count() >= 2
    d = reg.descriptive(c, tables)
    assert d["meds"].count() == 8
    assert d["sofa"].count() == c.count()
    assert d["sofa_distribution"].count() == 7
    assert d["table1"].where("variable = 'N'").collect()[0]["value"] == c.count()
    assert d["modes"].where("mode_category = 'Total'").count() == 2


def test_v1_heights_and_standard_labs(spark):
    from conftest import ts
    win = spark.createDataFrame([("h", ts("2024-01-01 00:00:00"), ts("2024-01-02 00:00:00"))],
                                "hospitalization_id string, min_in_dttm timestamp_ntz, after_24hr timestamp_ntz")
    vit = spark.createDataFrame([("h", ts("2024-01-01 01:00:00"), "weight_kg", "80"),
                                 ("h", ts("2024-01-01 01:00:00"), "height_inches", "70"),
                                 ("h", ts("2024-01-01 02:00:00"), "pulse", "90")],
                                "hospitalization_id string, recorded_dttm timestamp_ntz, vital_category string, vital_value string")
    r = reg.vital_features(win, vit, version=1).collect()[0]
    assert abs(r["avg_bmi"] - 80 / (1.778 ** 2)) < 1e-9 and r["max_pulse"] == 90.0
    labs = spark.createDataFrame([("h", ts("2024-01-01 01:00:00"), "sodium", "140", "standard"),
                                  ("h", ts("2024-01-01 02:00:00"), "sodium", "150", "poc")],
                                 "hospitalization_id string, lab_order_dttm timestamp_ntz, lab_category string, lab_value string, lab_type_name string")
    assert reg.lab_features(win, labs, standard_only=True).collect()[0]["sodium_max"] == 140.0
    assert reg.lab_features(win, labs).collect()[0]["sodium_max"] == 150.0
