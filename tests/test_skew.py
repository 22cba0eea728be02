"""Hot-key correctness: one id holds a third of all rows (derived from the driver's events),
so the bucketed operators carry state across many buckets of that id."""
import pandas as pd
from pyspark.sql import functions as F

from vigil.operators import cohort as coh
from vigil.operators import temporal as tp

D = "/root/testdata/sf0.01"


def hot_events(spark):
    e = spark.read.parquet(f"{D}/events.parquet")
    hot = F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    return e.withColumn("user_id", hot.cast("string"))


def test_asof_with_hot_id_matches_pandas(spark):
    e = hot_events(spark)
    doses = e.where("event_type = 'purchase'").select(F.col("user_id").alias("id"), F.col("ts").alias("t"), "event_id")
    w = e.where("event_type = 'view'").select(F.col("user_id").alias("id"), F.col("ts").alias("wt"),
                                              F.col("value").alias("kg"), F.col("event_id").alias("wid"))
    got = tp.asof_join(doses, w, id_col="id", left_t="t", right_t="wt", values=["kg", "wid"], right_tie="wid",
                       bucket="DAY").toPandas().set_index("event_id")["wid"]
    L = doses.toPandas().sort_values("t")
    R = w.toPandas().sort_values("wt")
    exp = pd.merge_asof(L, R, left_on="t", right_on="wt", by="id", direction="backward",
                        allow_exact_matches=True).set_index("event_id")["wid"]
    assert (L["id"] == "0").mean() > 0.3
    pd.testing.assert_series_equal(got.sort_index().astype("float64"), exp.sort_index().astype("float64"),
                                   check_names=False)


def test_state_blocks_with_hot_id(spark):
    e = hot_events(spark)
    s = e.select(F.col("user_id").alias("hospitalization_id"), F.col("event_type").alias("location_category"),
                 F.col("ts").alias("in_dttm"), F.col("ts").alias("out_dttm"), "event_id")
    a = coh.state_blocks(s, tie="event_id", bucket=None).toPandas()
    b = coh.state_blocks(s, tie="event_id", bucket="HOUR").toPandas()
    key = ["hospitalization_id", "block"]
    pd.testing.assert_frame_equal(a.sort_values(key).reset_index(drop=True),
                                  b.sort_values(key).reset_index(drop=True))
    assert a[a.hospitalization_id == "0"].n_rows.sum() > len(e.toPandas()) * 0.3
