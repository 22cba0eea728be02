"""Steps whose work must not be repeated or grow faster than the rows: bootstrap draws, site files, histogram, organ score, model rows."""
import random

import numpy as np
from pyspark.sql import functions as F

from vigil.operators import bootstrap as bs
from vigil.operators import clinical as cl
from vigil.operators import profile as pf
from vigil.plans import catalog


def test_draws_are_those_of_whole_numbers():
    top = (1 << 28) - 1
    keys = np.array([[0, 0, 0], [top, top, top], [1, 0, top], [top, 1, 0], [123456789, 7, 99]])
    for digit in (0, 5, 64, 90):
        got = bs.draws(keys, digit, np.arange(40))
        for (a, b, c), row in zip(keys.tolist(), got.tolist()):
            for r, x in enumerate(row):
                n = a + (r + 1) * bs.STEP_REPLICATE + (digit + 1) * bs.STEP_DIGIT
                assert x == (pow(pow(n, 5, bs.PRIME) + b, 5, bs.PRIME) + c) % bs.PRIME


def test_looked_up_weights_are_those_of_the_thresholds():
    rng = np.random.default_rng(3)
    for mean in (1, 2, 1 << 7, 1 << 14):
        thresholds, weight = bs.poisson_lookup(mean)
        near = (thresholds[:, None] + np.arange(-2, 3)).ravel()
        x = np.concatenate([near[(near >= 0) & (near < bs.PRIME)], rng.integers(0, bs.PRIME, 20000), [0, bs.PRIME - 1]])
        w = weight[x >> bs.SHIFT]
        true = np.searchsorted(thresholds, x, "right")
        assert ((w == true) | (w < 0)).all() and (w[-20002:] >= 0).mean() > 0.9


def test_weights_do_not_depend_on_slices(monkeypatch):
    rng = np.random.default_rng(4)
    keys, count = rng.integers(0, 1 << 28, (300, 3)), rng.integers(0, 20, 300)
    whole = bs._weights(keys, count, 1, np.arange(8), {})
    monkeypatch.setattr(bs, "SLICE", 7)
    assert (bs._weights(keys, count, 1, np.arange(8), {}) == whole).all() and (whole[count == 0] == 0).all()


def test_site_metrics_are_computed_once_for_all_files(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def once(v):
        seen.add(1)
        return v

    rows = [(s, m, 0.5) for s in ("AFRICA", "ASIA", "EUROPE") for m in ("ROC AUC", "Brier Score Loss")]
    t = spark.createDataFrame(rows, "site string, metric string, value double").withColumn("value", F.udf(once, "double").asNondeterministic()("value"))
    t = t.withColumns({"ci_lower": F.lit(0.4), "ci_upper": F.lit(0.6)})
    monkeypatch.setattr(catalog, "q_metrics_table", lambda *_: t)
    got = {r.site: r for r in catalog.QUERIES["site_table_from_files"](spark, "unused").collect()}
    assert len(got) == 3 and got["ASIA"].site_name == "Asia Region" and got["EUROPE"].auc_ci_upper == 0.6
    assert seen.value == len(rows)


def _counted(values, bins):
    known = [v for v in values if v is not None]
    lo, step = min(known), (max(known) - min(known)) / float(bins)
    n = {}
    for v in known:
        b = sum(k * step + lo <= v for k in range(1, bins))
        n[b, b * step + lo] = n.get((b, b * step + lo), 0) + 1
    return n


def test_histogram_places_every_value_as_all_edges_do(spark):
    rng = random.Random(5)
    cols = {"a": [rng.random() for _ in range(200)], "b": [1e16 + rng.randrange(9) for _ in range(200)], "c": [3.5] * 200,
            "d": [None if i % 3 else float(i % 10) / 10 for i in range(200)], "e": [None] * 200}
    df = spark.createDataFrame([*zip(*cols.values())], ", ".join(f"{c} double" for c in cols))
    h = pf.histogram(df, list(cols), bins=30)
    got = {c: {(r.bin, r.bin_lower): r.n for r in h.where(F.col("feature") == c).collect()} for c in cols}
    assert got == {c: _counted(v, 30) if c != "e" else {} for c, v in cols.items()}
    assert "lambda" not in h._jdf.queryExecution().executedPlan().toString(), "edges are walked one by one for each value"


def _organ_inputs(spark, rng):
    import datetime as dt
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    ids = [f"h{i}" for i in range(12)]
    rows = {"vitals": [], "labs": [], "gcs": [], "meds": [], "resp": []}
    for i in ids[:-1]:  # the last one has no rows
        for _ in range(30):
            t = at(rng.randrange(-5, 60))
            rows["vitals"].append((i, t, rng.choice(["spo2", "map", "other"]), rng.choice([None, 55.0, 62.0, 88.0, 96.5, 97.0, 100.0, 20.0])))
            rows["labs"].append((i, t, rng.choice(["creatinine", "bilirubin_total", "po2_arterial", "platelet_count", "x"]), rng.choice([None, -1.0, 0.5, 4.0, 60.0, 130.0, 900.0])))
            rows["gcs"].append((i, t, rng.choice([None, 3, 9, 12, 15])))
            rows["meds"].append((i, t, rng.choice(["dopamine", "epinephrine", "norepinephrine", "dobutamine", "x"]), rng.choice([None, 0.0, 0.05, 3.0, 20.0])))
            rows["resp"].append((i, t, rng.choice([None, "IMV", "NIPPV", "Nasal Cannula", "Room Air", "x"]), rng.choice([None, "simv"]), rng.choice([None, 0.21, 0.5, 1.5]),
                                 rng.choice([None, 0.0, 5.0, 30.0]), rng.choice([None, 5.0]), rng.choice([None, 400.0])))
    rows["vitals"].append((None, at(1), "map", 40.0))
    windows = [(i, at(0), at(24)) for i in ids] + [("h0", at(30), at(50)), (None, at(0), at(24))]
    made = {"vitals": "vital_category string, vital_value double", "labs": "lab_category string, lab_value_numeric double", "gcs": "numerical_value int",
            "meds": "med_category string, med_dose_converted double",
            "resp": "device_category string, mode_category string, fio2_set double, lpm_set double, peep_set double, tidal_volume_set double"}
    time = {"labs": "lab_order_dttm", "meds": "admin_dttm"}
    frames = {k: spark.createDataFrame(v, f"hid string, {time.get(k, 'recorded_dttm')} timestamp_ntz, {made[k]}") for k, v in rows.items()}
    return spark.createDataFrame(windows, "hid string, min_in_dttm timestamp_ntz, after_24hr timestamp_ntz"), frames, windows, rows


def test_organ_score_takes_the_worst_inside_the_windows_in_one_join(spark):
    w, frames, windows, rows = _organ_inputs(spark, random.Random(6))
    s = cl.organ_score(w, id_col="hid", **frames)
    got = [r.asDict() for r in s.collect()]
    assert len(got) == len(windows)

    def inside(kind):
        return lambda i: [r[2:] for r in rows[kind] if i and r[0] == i and any(i == x[0] and x[1] <= r[1] <= x[2] for x in windows)]

    ends = {"map_min": (inside("vitals"), "map", min, 30, 1e9), "spo2_min": (inside("vitals"), "spo2", min, 60, 1e9), "creatinine_max": (inside("labs"), "creatinine", max, 0, 20),
            "platelet_count_min": (inside("labs"), "platelet_count", min, 0, 2000), "po2_arterial_min": (inside("labs"), "po2_arterial", min, 30, 700),
            "dopamine": (inside("meds"), "dopamine", max, -1e9, 1e9), "dobutamine": (inside("meds"), "dobutamine", max, -1e9, 1e9)}
    for r in got:
        for name, (of, cat, worst, lo, hi) in ends.items():
            assert r[name] == worst((v for c, v in of(r["hid"]) if c == cat and v is not None and lo <= v <= hi), default=None), (r["hid"], name)
        assert r["min_gcs_score"] == min((v for v, in inside("gcs")(r["hid"]) if v is not None), default=None)
    assert sum(r["sofa_97_24hr"] for r in got) > 0 and {r["resp_support_max"] for r in got} >= {"Vent", None}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = cl.organ_score(w, id_col="hid", **frames)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("SortMergeJoin") == 2, "values meet the windows once, and the windows their worst values once"


def test_model_rows_are_joined_once(spark, monkeypatch):
    fits = []
    monkeypatch.setattr(catalog.mdl, "train", lambda df, features: fits.append(df))
    catalog._fit(spark, "/root/testdata/sf0.001")
    plan = fits[0]._jdf.queryExecution().executedPlan().toString()
    assert all("/model-frame-" in f for f in fits[0].inputFiles()) and "Join" not in plan and "Exchange" not in plan
