"""NULL keys and times lose no rows."""
import numpy as np
import pytest

from conftest import ts
from vigil.operators import bootstrap as bs
from vigil.operators import evaluate as ev
from vigil.operators.cohort import state_blocks
from vigil.operators.ordered import exact_quantiles
from vigil.operators.reshape import dedupe_eav
from vigil.operators.temporal import asof_join, next_time

SCORED = "site string, label int, score double"


def scored(spark):
    return spark.createDataFrame([("a", 1, 0.9), ("a", 0, 0.2), (None, 1, 0.8), (None, 0, 0.3), (None, 0, 0.8)], SCORED)


def test_ladder_metrics_and_curves_keep_the_null_group(spark):
    df = scored(spark)
    lad = ev.score_ladder(df, by=["site"])
    assert sum(r["pos"] + r["neg"] for r in lad.collect()) == 5
    got = {(r["site"], r["metric"]): r["value"] for r in ev.headline_metrics(df, by=["site"]).collect()}
    assert got[None, "ROC AUC"] == pytest.approx(0.75) and got["a", "ROC AUC"] == 1.0
    for frame in (ev.roc_points(lad, ["site"]), ev.pr_points(lad, ["site"]), ev.curve_areas(lad, ["site"]), ev.topn_sweep(df, by=["site"]),
                  ev.calibration_equal_width(df, by=["site"])):
        assert {r["site"] for r in frame.select("site").distinct().collect()} == {"a", None}
    q = exact_quantiles(df, ["site"], "score", [0.5]).collect()
    assert {(r["site"], round(r["value"], 6)) for r in q} == {("a", 0.55), (None, 0.8)}


def test_fairness_keeps_the_null_site(spark):
    df = scored(spark).selectExpr("*", "'x' AS sex")
    got = {r["site"]: (r["group_count"], r["total_count"]) for r in ev.fairness(df, subgroups=["sex"], by=["site"]).collect()}
    assert got == {"a": (2, 2), None: (3, 3)}


def test_blocks_and_next_time_keep_null_ids_and_times(spark):
    rows = [("1", "ICU", ts("2024-01-01 00:00:00"), ts("2024-01-02 00:00:00")), (None, "ICU", ts("2024-01-01 00:00:00"), None), ("2", "WARD", None, None)]
    df = spark.createDataFrame(rows, "hospitalization_id string, location_category string, in_dttm timestamp_ntz, out_dttm timestamp_ntz")
    for bucket in ("DAY", None):
        assert sum(r["n_rows"] for r in state_blocks(df, bucket=bucket).collect()) == 3
        assert next_time(df, id_col="hospitalization_id", t="in_dttm", bucket=bucket).count() == 3


@pytest.mark.parametrize("bucket", ["DAY", None])
def test_asof_ignores_right_rows_without_id_or_time(spark, bucket):
    left = spark.createDataFrame([("1", ts("2024-01-01 05:00:00")), ("1", None), (None, ts("2024-01-01 05:00:00"))], "id string, t timestamp_ntz")
    right = spark.createDataFrame([("1", None, 70.0), (None, ts("2024-01-01 01:00:00"), 9.0)], "id string, rt timestamp_ntz, w double")
    got = asof_join(left, right, id_col="id", left_t="t", right_t="rt", values=["w"], bucket=bucket).collect()
    assert len(got) == 3 and all(r["w"] is None and r["rt"] is None for r in got)


def test_dedupe_prefers_a_value_to_null(spark):
    df = spark.createDataFrame([(1, "hr", None), (1, "hr", 80.0)], "id int, cat string, v double")
    assert dedupe_eav(df, keys=["id"], cat="cat", value="v").collect()[0]["v"] == 80.0


def test_bootstrap_groups_have_own_streams_and_blocks_are_exact(spark):
    rng = np.random.default_rng(1)
    s = rng.random(400)
    y = (rng.random(400) < s).astype(int)
    rows = [(site, int(a), float(b)) for site in ("a", "b", None) for a, b in zip(y, s)]
    df = spark.createDataFrame(rows, SCORED)
    out = {}
    for block in (16, 4096):
        for r in bs.bootstrap_ci(df, by=["site"], thr=0.3, replicates=300, block=block).collect():
            out[block, r["site"], r["metric"]] = (r["ci_lower"], r["ci_upper"])
    assert len(out) == 30
    assert out[16, "a", "ROC AUC"] != out[16, "b", "ROC AUC"]
    idx = rng.integers(0, 400, (300, 400))
    acc = ((s[idx] >= 0.3) == y[idx]).mean(axis=1)
    for block in (16, 4096):
        lo, hi = out[block, None, "Accuracy"]
        assert lo == pytest.approx(np.quantile(acc, 0.025), abs=0.02) and hi == pytest.approx(np.quantile(acc, 0.975), abs=0.02)
        assert np.allclose(out[block, "a", "Brier Score Loss"], out[4096, "a", "Brier Score Loss"], atol=0.01)
