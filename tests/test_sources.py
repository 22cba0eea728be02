import os
import tempfile

import pytest

from conftest import ts
from vigil.sources import load_table, write_shareable, SCHEMAS


def test_csv_and_parquet_and_unknown(spark):
    root = tempfile.mkdtemp(prefix="vigil-src-")
    rows = [("h1", "ICU", ts("2020-01-01 00:00:00"), ts("2020-01-02 00:00:00"))]
    df = spark.createDataFrame(rows, SCHEMAS["adt"])
    df.write.parquet(os.path.join(root, "adt.parquet"))
    df.write.option("header", True).csv(os.path.join(root, "adt.csv"))
    a = load_table(spark, "adt", root, "parquet").collect()
    b = load_table(spark, "adt", root, "csv").collect()
    assert a == b and a[0]["in_dttm"] == ts("2020-01-01 00:00:00")
    with pytest.raises(ValueError):
        load_table(spark, "adt", root, "fst")


def test_v1_renames_and_id_cast(spark):
    root = tempfile.mkdtemp(prefix="vigil-src-")
    spark.createDataFrame([(7, "Expired")], "encounter_id long, disposition string").write.parquet(
        os.path.join(root, "enc.parquet"))
    r = load_table(spark, "enc", root, version=1)
    assert r.columns == ["hospitalization_id", "discharge_category"]
    assert dict(r.dtypes)["hospitalization_id"] == "string"


def test_shareable_refuses_ids(spark):
    df = spark.createDataFrame([("h1", 1.0)], "hospitalization_id string, v double")
    with pytest.raises(ValueError):
        write_shareable(df, tempfile.mkdtemp())


def test_parse_timestamp_and_drop_zone(spark):
    from vigil.functions import parse_timestamp
    from vigil.sources import to_ntz
    df = spark.createDataFrame([("2020-01-01 10:00:00",), ("garbage",)], "s string")
    r = [x[0] for x in df.select(parse_timestamp("s")).collect()]
    assert r[0] == ts("2020-01-01 10:00:00") and r[1] is None
    z = spark.createDataFrame([("h", 1)], "hospitalization_id string, x int").selectExpr(
        "hospitalization_id", "TIMESTAMP '2020-01-01 10:00:00' AS t")
    out = to_ntz(z)
    assert dict(out.dtypes)["t"] == "timestamp_ntz" and out.collect()[0]["t"] == ts("2020-01-01 10:00:00")


def test_csv_is_read_by_name(spark):
    root = tempfile.mkdtemp(prefix="vigil-src-")
    with open(os.path.join(root, "adt.csv"), "w") as f:
        f.write("in_dttm,extra,location_category,out_dttm,hospitalization_id\n2024-01-01 00:00:00,x,ICU,2024-01-02 00:00:00,007\nnot a time,,WARD,,8\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load_table(spark, "adt", root, "csv").collect()
    rows = load_table(spark, "adt", root, "csv", strict=False).orderBy("hospitalization_id").collect()
    assert rows[0].asDict() == {"hospitalization_id": "007", "location_category": "ICU", "in_dttm": ts("2024-01-01 00:00:00"),
                                "out_dttm": ts("2024-01-02 00:00:00"), "extra": "x"}
    assert rows[1]["in_dttm"] is None and rows[1]["out_dttm"] is None


def test_csv_v1_names_missing_and_extra_columns(spark):
    root = tempfile.mkdtemp(prefix="vigil-src-")
    with open(os.path.join(root, "labs.csv"), "w") as f:
        f.write("lab_type_name,encounter_id,lab_order_dttm,lab_category,lab_value,reference_unit\nstandard,1,2024-01-01 00:00:00,sodium,140,mmol/L\n")
    r = load_table(spark, "labs", root, "csv", version=1).collect()[0]
    assert (r["hospitalization_id"], r["lab_value_numeric"], r["lab_type_name"], r["reference_unit"]) == ("1", None, "standard", "mmol/L")
    with pytest.raises(ValueError, match="hospitalization_id"):
        load_table(spark, "labs", root, "csv")


def test_shareable_refuses_row_level_scores(spark):
    df = spark.createDataFrame([(1, 0, 0.5)], "n int, label int, pred_proba double")
    with pytest.raises(ValueError):
        write_shareable(df, tempfile.mkdtemp())
    with pytest.raises(ValueError):
        write_shareable(df.select("n", "pred_proba"), tempfile.mkdtemp())


def _metrics(name, rows):
    return name + "\n" + "\n".join(rows) + "\n"


def test_site_files_by_header_and_quarantine(spark, tmp_path):
    from vigil.sources import quarantined_site_lines, read_site_results
    from vigil.streaming.site_results import METRICS_SCHEMA
    (tmp_path / "m_A.csv").write_text(_metrics("site,metric,value,ci_lower,ci_upper", ['A,ROC AUC,0.8,0.7,0.9', 'A,"odd, ""name""",0.1,,', "A,short,0.5"]))
    (tmp_path / "m_B.csv").write_text("﻿" + _metrics("metric, value,ci_lower,ci_upper,extra,site", ["ROC AUC,0.6,0.5,0.7,x,B", "Recall,many,0.1,0.2,,B", ""]).replace("\n", "\r\n"))
    (tmp_path / "m_C.csv").write_text(_metrics("site,metric,value", ["C,ROC AUC,0.9"]))
    got = sorted(tuple(r) for r in read_site_results(spark, f"{tmp_path}/m_*.csv", METRICS_SCHEMA).collect())
    assert got == [("A", "ROC AUC", 0.8, 0.7, 0.9), ("A", 'odd, "name"', 0.1, None, None), ("B", "ROC AUC", 0.6, 0.5, 0.7)]
    bad = sorted((r.file[-7:], r.line, r.fault) for r in quarantined_site_lines(spark, f"{tmp_path}/m_*.csv", METRICS_SCHEMA).collect())
    assert bad == [("m_A.csv", 4, "number of fields"), ("m_B.csv", 3, "value of value"), ("m_C.csv", 2, "no column ci_lower")]


def test_site_files_are_written_one_a_site_and_read_back(spark, tmp_path):
    from vigil.sources import read_site_results, write_row_level, write_site_files
    from vigil.streaming.site_results import METRICS_SCHEMA
    rows = [(s, m, 0.5, None, 0.75) for s in ("A", "B b", "C/d") for m in ("ROC AUC", "Recall, all")]
    df = spark.createDataFrame(rows, METRICS_SCHEMA).repartition(4)
    write_site_files(df, f"{tmp_path}/out")
    assert len(list(tmp_path.glob("out/*/*.csv"))) == 3
    back = read_site_results(spark, f"{tmp_path}/out/*/*.csv", METRICS_SCHEMA)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    with pytest.raises(ValueError):
        write_site_files(df.withColumnRenamed("metric", "patient_id"), f"{tmp_path}/no")
    write_row_level(df, f"{tmp_path}/rows")
    assert spark.read.parquet(f"{tmp_path}/rows").count() == 6 and len(list(tmp_path.glob("rows/site=*"))) == 3
