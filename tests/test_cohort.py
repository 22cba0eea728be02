"""Hand-made cohort cases (FIXTURES section 2)."""
from conftest import ts
from vigil.operators import cohort as coh

ENC = "patient_id string, hospitalization_id string, age_at_admission double, discharge_category string, admission_dttm timestamp_ntz"
ADT = "hospitalization_id string, location_category string, in_dttm timestamp_ntz, out_dttm timestamp_ntz, k int"


def stays(spark, rows):
    out, t = [], {}
    for hid, seq in rows.items():
        cur = ts("2020-06-01 00:00:00")
        for i, (loc, hours) in enumerate(seq):
            import datetime as dt
            nxt = cur + dt.timedelta(hours=hours)
            out.append((hid, loc, cur, nxt, i))
            cur = nxt
    return spark.createDataFrame(out, ADT)


def enc(spark, ids, adm="2020-06-01 00:00:00", age=60.0):
    return spark.createDataFrame([("p" + i, i, age, "Expired", ts(adm)) for i in ids], ENC)


def run(spark, s, e, **kw):
    return {r["hospitalization_id"]: r for r in coh.first_block(s, e, tie="k", **kw).collect()}


def test_or_between_icu_merges(spark):
    s = stays(spark, {"a": [("ICU", 10), ("procedural", 6), ("icu", 10)]})
    r = run(spark, s, enc(spark, ["a"]))
    assert set(r) == {"a"}
    hrs = (r["a"]["max_out_dttm"] - r["a"]["min_in_dttm"]).total_seconds() / 3600
    assert hrs == 26


def test_first_icu_block_only(spark):
    s = stays(spark, {"b": [("Ward", 2), ("ICU", 30), ("Ward", 5), ("ICU", 40)]})
    r = run(spark, s, enc(spark, ["b"]))
    assert (r["b"]["max_out_dttm"] - r["b"]["min_in_dttm"]).total_seconds() == 30 * 3600


def test_short_first_block_drops_encounter(spark):
    s = stays(spark, {"c": [("ICU", 20), ("Ward", 1), ("ICU", 40)]})
    assert run(spark, s, enc(spark, ["c"])) == {}


def test_inclusive_edges(spark):
    import datetime as dt
    rows = [("d", "ICU", ts("2020-06-03 00:00:00"), ts("2020-06-04 00:00:00"), 0)]
    s = spark.createDataFrame(rows, ADT)
    r = run(spark, s, enc(spark, ["d"], adm="2020-06-01 00:00:00"))
    assert "d" in r  # entry exactly 48 h after admission, stay exactly 24 h


def test_exclusions(spark):
    # entry before admission only; age 17; age NULL; admitted 2019
    s = stays(spark, {"e1": [("ICU", 30)], "e2": [("ICU", 30)], "e3": [("ICU", 30)], "e4": [("ICU", 30)]})
    e = spark.createDataFrame([
        ("p1", "e1", 50.0, None, ts("2020-06-01 05:00:00")),
        ("p2", "e2", 17.0, None, ts("2020-06-01 00:00:00")),
        ("p3", "e3", None, None, ts("2020-06-01 00:00:00")),
        ("p4", "e4", 50.0, None, ts("2019-06-01 00:00:00")),
    ], ENC)
    s4 = s.where("hospitalization_id <> 'e4'").unionByName(
        spark.createDataFrame([("e4", "ICU", ts("2019-06-01 00:00:00"), ts("2019-06-03 00:00:00"), 0)], ADT))
    assert run(spark, s4, e) == {}


def test_null_location_splits_blocks(spark):
    s = stays(spark, {"f": [("ICU", 5), (None, 1), ("ICU", 5)]})
    b = coh.state_blocks(s.withColumn("location_category", coh.normalise_state("location_category")), tie="k")
    assert b.count() == 3
    assert sorted(r["block"] for r in b.collect()) == [1, 2, 3]


def test_demographics_flags(spark):
    c = spark.createDataFrame([("h1", "p1", "Expired", ts("2020-01-01 00:00:00"), ts("2020-01-02 06:00:00")),
                               ("h2", "p2", None, ts("2020-01-01 00:00:00"), ts("2020-01-01 12:00:00")),
                               ("h3", "p3", "Home", ts("2020-01-01 00:00:00"), ts("2020-01-01 12:00:00"))],
                              "hospitalization_id string, patient_id string, dispo string, min_in_dttm timestamp_ntz, max_out_dttm timestamp_ntz")
    p = spark.createDataFrame([("p1", "White", "Hispanic", "Female"), ("p2", "Martian", None, "Male"),
                               ("p3", "Asian", "Refusal", None)],
                              "patient_id string, race_category string, ethnicity_category string, sex_category string")
    r = {x["hospitalization_id"]: x for x in coh.demographics(c, p).collect()}
    assert set(r) == {"h1", "h2"}                      # missing sex dropped
    assert r["h1"]["isdeathdispo"] == 1 and r["h2"]["isdeathdispo"] == 0
    assert r["h1"]["isfemale"] == 1 and r["h2"]["race"] == "Others"
    assert r["h2"]["ethnicity"] == "Not Hispanic or Latino" and r["h1"]["ethnicity"] == "Hispanic or Latino"
    assert abs(r["h1"]["ICU_stay_hrs"] - 30.0) < 1e-9


def test_state_blocks_bucketed_equals_plain(spark):
    import datetime as dt
    import random
    rnd = random.Random(5)
    rows, k = [], 0
    for hid in ["a", "b", "c"]:
        t = ts("2020-01-01 00:00:00")
        for _ in range(200):
            t += dt.timedelta(hours=rnd.choice([1, 3, 7, 30]))
            rows.append((hid, rnd.choice(["ICU", "Ward", None, "OR"]), t, t + dt.timedelta(hours=1), k))
            k += 1
    s = spark.createDataFrame(rows, ADT)
    a = sorted(map(tuple, coh.state_blocks(s, tie="k", bucket=None, merge={"OR": "ICU"}).collect()),
               key=lambda r: (r[0], r[1]))
    b = sorted(map(tuple, coh.state_blocks(s, tie="k", bucket="DAY", merge={"OR": "ICU"}).collect()),
               key=lambda r: (r[0], r[1]))
    assert a == b and min(r[1] for r in a) == 1


def test_first_row_null_state_opens_block_one(spark):
    s = stays(spark, {"g": [(None, 2), (None, 2), ("ICU", 5)]})
    b = sorted(r["block"] for r in coh.state_blocks(s, tie="k").collect())
    assert b == [1, 2]


def test_next_time_bucketed(spark):
    import datetime as dt
    from vigil.operators.temporal import next_time
    rows = [("u", ts("2020-01-01 23:00:00") + dt.timedelta(hours=h), i) for i, h in enumerate([0, 0, 5, 50, 51])]
    df = spark.createDataFrame(rows, "id string, t timestamp_ntz, k int")
    a = {r["k"]: r["next_t"] for r in next_time(df, id_col="id", t="t", tie="k", bucket=None).collect()}
    b = {r["k"]: r["next_t"] for r in next_time(df, id_col="id", t="t", tie="k", bucket="DAY").collect()}
    assert a == b and a[4] is None and a[2] == rows[3][1]
