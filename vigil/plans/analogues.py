"""Registry-shaped inputs derived from the driver's TPC-H-like tables.

The driver's data has no ICU tables, so each registry table is an analogue (mapping
fixed in FIXTURES.md section 3).  Every analogue is a lazy DataFrame over the full
parquet tables; nothing is sampled or capped.  NULL paths are forced with
``id % k = 0`` rules, mirrored in the SQL oracles.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, trunc_ntz

# Fixed values of the analogue mapping (mirrored in plans/oracle.py).
DRUG_BY_MOD8 = fixed.REQUIRED_MEDS
UNIT_BY_MOD5 = ["mcg/kg/min", "MCG/MIN", "mg/hr", "units/min", "ng/kg/min"]
RACE_BY_SEGMENT = {"AUTOMOBILE": "White", "BUILDING": "Black or African American",
                   "FURNITURE": "Asian", "HOUSEHOLD": "Unknown", "MACHINERY": "Multiple"}
ETHNICITY_BY_MOD4 = ["Hispanic", "Non-Hispanic", "*Unspecified", None]
DEVICE_BY_FLAG = {"R": "IMV", "A": "NIPPV", "N": None}
MODE_BY_STATUS = {"O": "Pressure Control", "F": "simv"}


def _pick(col, values):
    """values[col] as a CASE chain (col is a 0-based integer column)."""
    e = None
    for i, v in enumerate(values):
        e = F.when(col == i, F.lit(v)) if e is None else e.when(col == i, F.lit(v))
    return e


class Analogue:
    """Lazily built analogue tables for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """One relation per table (file listing and footer read once per query plan)."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._tables[name]

    # ---- stays and encounters (events, customer, orders) ---------------------------------
    def stays(self) -> DataFrame:
        """ADT analogue: one stay per event; out = next event of the user."""
        from ..operators.temporal import next_time
        e = next_time(self.table("events"), id_col="user_id", t="ts", tie="event_id", out="_next")
        loc = (F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("string"))
               .when(F.col("event_type") == "purchase", F.lit("icu"))
               .when(F.col("event_type") == "signup", F.lit("procedural"))
               .otherwise(F.col("event_type")))
        return e.select(F.col("user_id").cast("string").alias("hospitalization_id"),
                        loc.alias("location_category"), F.col("ts").alias("in_dttm"),
                        F.col("_next").alias("out_dttm"), "event_id")

    def encounters(self) -> DataFrame:
        """Hospitalization analogue: customer; admission = first event of the user;
        discharge = priority of the customer's latest order."""
        c = self.table("customer")
        adm = self.table("events").groupBy("user_id").agg(F.min("ts").alias("admission_dttm"))
        last = (self.table("orders").groupBy("o_custkey")
                .agg(F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey"))
                     .alias("_prio")))
        age = F.when(F.col("c_custkey") % 13 == 0, F.lit(None).cast("double")).otherwise(
            (F.abs(F.floor("c_acctbal")) % 80 + 10).cast("double"))
        return (c.join(adm, c.c_custkey == adm.user_id, "left")
                .join(last, c.c_custkey == last.o_custkey, "left")
                .select(F.col("c_custkey").cast("string").alias("hospitalization_id"),
                        F.col("c_custkey").cast("string").alias("patient_id"),
                        age.alias("age_at_admission"),
                        F.when(F.col("c_custkey") % 7 == 0, F.lit(None).cast("string"))
                        .otherwise(F.col("_prio")).alias("discharge_category"),
                        "admission_dttm"))

    def patients(self) -> DataFrame:
        c = self.table("customer")
        race = F.col("c_mktsegment")
        race_e = None
        for k, v in RACE_BY_SEGMENT.items():
            race_e = (F.when(race == k, F.lit(v)) if race_e is None else race_e.when(race == k, F.lit(v)))
        sex = (F.when(F.col("c_custkey") % 11 == 0, F.lit(None).cast("string"))
               .when(F.col("c_nationkey") % 2 == 0, F.lit("Female")).otherwise(F.lit("Male")))
        return c.select(F.col("c_custkey").cast("string").alias("patient_id"),
                        race_e.alias("race_category"),
                        _pick(F.col("c_nationkey") % 4, ETHNICITY_BY_MOD4).alias("ethnicity_category"),
                        sex.alias("sex_category"))

    # ---- observations (events) --------------------------------------------------------------
    def observations(self) -> DataFrame:
        """Vitals-shaped long table: (id, time, category, value, text value, tie)."""
        e = self.table("events")
        txt = (F.when(F.col("event_id") % 23 == 0, F.lit(None).cast("string"))
               .when(F.col("event_id") % 17 == 0, F.concat(F.lit(">"), F.col("value").cast("string")))
               .otherwise(F.col("value").cast("string")))
        return e.select(F.col("user_id").cast("string").alias("hospitalization_id"),
                        F.col("ts").alias("recorded_dttm"),
                        F.col("event_type").alias("vital_category"),
                        F.when(F.col("event_id") % 23 == 0, F.lit(None).cast("double"))
                        .otherwise(F.col("value")).alias("vital_value"),
                        txt.alias("vital_text"), "event_id")

    def registry_vitals(self, categories) -> DataFrame:
        """The observations under the registry's vital names (by event_id), charted by the hour."""
        o = self.observations()
        return o.select("hospitalization_id", trunc_ntz("HOUR", "recorded_dttm").alias("recorded_dttm"),
                        _pick(F.col("event_id") % len(categories), categories).alias("vital_category"),
                        F.col("vital_value").cast("string").alias("vital_value"))

    def registry_labs(self, categories) -> DataFrame:
        """The observations as labs under the registry's names, some with text like '>90'."""
        o = self.observations()
        return o.select("hospitalization_id", trunc_ntz("HOUR", "recorded_dttm").alias("lab_order_dttm"),
                        _pick(F.col("event_id") % len(categories), categories).alias("lab_category"),
                        F.col("vital_text").alias("lab_value"))

    def doses(self) -> DataFrame:
        """Continuous medication analogue from 'purchase' events."""
        e = self.table("events").where(F.col("event_type") == "purchase")
        return e.select(F.col("user_id").cast("string").alias("hospitalization_id"),
                        F.col("ts").alias("admin_dttm"),
                        _pick(F.col("event_id") % 8, DRUG_BY_MOD8).alias("med_category"),
                        F.when(F.col("event_id") % 29 == 0, F.lit(None).cast("double"))
                        .otherwise(F.col("value")).alias("med_dose"),
                        _pick(F.col("event_id") % 5, UNIT_BY_MOD5).alias("med_dose_unit"),
                        "event_id")

    def weights(self) -> DataFrame:
        """Weight measurements from 'view' events."""
        e = self.table("events").where(F.col("event_type") == "view")
        return e.select(F.col("user_id").cast("string").alias("hospitalization_id"),
                        F.col("ts").alias("recorded_dttm"),
                        F.col("value").alias("weight_kg"), F.col("event_id").alias("w_event_id"))

    # ---- respiratory settings (lineitem) ----------------------------------------------------
    def settings(self) -> DataFrame:
        li = self.table("lineitem")
        dev = F.col("l_returnflag")
        device = F.when(dev == "R", F.lit("IMV")).when(dev == "A", F.lit("NIPPV")).otherwise(
            F.lit(None).cast("string"))
        mode = (F.when(F.col("l_linenumber") == 1, F.lit(""))
                .when(F.col("l_linenumber") == 7, F.lit("Unlisted Mode"))
                .when(F.col("l_linestatus") == "O", F.lit("Pressure Control"))
                .otherwise(F.lit("simv")))
        return li.select(F.col("l_orderkey").cast("string").alias("hospitalization_id"),
                         F.col("l_shipdate").alias("recorded_dttm"), "l_linenumber",
                         device.alias("device_category"), mode.alias("mode_category"),
                         (F.col("l_discount") * 10 + 0.0).alias("fio2_set"),
                         F.col("l_quantity").alias("peep_set"),
                         F.when(F.col("l_linenumber") % 3 == 0, F.col("l_tax") * 1000)
                         .alias("tidal_volume_set"),
                         F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity") / 2)
                         .alias("lpm_set"))

    def order_windows(self) -> DataFrame:
        """Per-order observation window: [order date, order date + 180 days]."""
        o = self.table("orders")
        return o.select(F.col("o_orderkey").cast("string").alias("hospitalization_id"),
                        F.col("o_orderdate").alias("min_in_dttm"),
                        (F.col("o_orderdate") + F.expr("INTERVAL 180 DAYS")).alias("after_24hr"))

    def sofa_wide(self) -> DataFrame:
        """One row per line item carrying every organ-score input (NULL patterns by line)."""
        li = self.table("lineitem")
        ln = F.col("l_linenumber")
        q, px, tax, disc = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_tax"), F.col("l_discount")
        return li.select(
            F.col("l_orderkey").cast("string").alias("hospitalization_id"),
            F.col("l_shipdate").alias("recorded_dttm"),
            F.when(ln != 2, F.lit(55.0) + q * 0.9).alias("spo2"),
            F.when(ln != 3, px / 1000.0).alias("map"),
            (tax * 100.0).alias("creatinine"),
            (disc * 150.0 + 0.0).alias("bilirubin_total"),
            (px / 100.0).alias("po2_arterial"),
            F.when(ln != 6, q * 4.0).alias("platelet_count"),
            F.when(ln != 4, (F.lit(3) + ln * 2).cast("double")).alias("gcs_total"),
            F.when(ln.isin(1, 4), tax * 3.0).alias("norepinephrine"),
            F.when(ln == 2, q / 3.0).alias("dopamine"),
            F.when(ln == 3, disc * 2.0 + 0.0).alias("epinephrine"),
            F.when(ln == 5, disc + 0.0).alias("dobutamine"))

    def sofa_inputs(self) -> dict:
        w = self.sofa_wide()
        k = ["hospitalization_id", "recorded_dttm"]
        vit = w.unpivot(k, ["spo2", "map"], "vital_category", "vital_value")
        labs = (w.unpivot(k, ["creatinine", "bilirubin_total", "po2_arterial", "platelet_count"],
                          "lab_category", "lab_value_numeric")
                .withColumnRenamed("recorded_dttm", "lab_order_dttm"))
        gcs = w.select(*k, F.col("gcs_total").alias("numerical_value"))
        meds = (w.unpivot(k, ["norepinephrine", "dopamine", "epinephrine", "dobutamine"], "med_category",
                          "med_dose_converted").withColumnRenamed("recorded_dttm", "admin_dttm"))
        return {"vitals": vit, "labs": labs, "gcs": gcs, "meds": meds, "resp": self.settings()}

    # ---- scored cases (orders) -----------------------------------------------------------
    def scored(self) -> DataFrame:
        """(id, label, score, priority, segment, site) from orders -> customer -> nation -> region."""
        o, c = self.table("orders"), self.table("customer")
        n, r = self.table("nation"), self.table("region")
        geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
        return (o.join(c, o.o_custkey == c.c_custkey, "left")
                .join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey, "left")
                .select(F.col("o_orderkey").cast("string").alias("case_id"),
                        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
                        (F.col("o_totalprice") / 500000.0).alias("score"),
                        F.when(F.col("o_orderkey") % 19 == 0, F.lit(None).cast("string"))
                        .otherwise(F.col("o_orderpriority")).alias("priority"),
                        F.col("c_mktsegment").alias("segment"),
                        F.col("r_name").alias("site"),
                        F.year("o_orderdate").alias("year")))
