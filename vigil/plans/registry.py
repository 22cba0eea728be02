"""The ICU study as one configured composition of vigil operators over registry tables
(version 2 names; version 1 is renamed on load).  Each function returns lazy DataFrames;
``descriptive`` and ``evaluation`` return dicts of them, one per output table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, lenient_number, safe_div, strict_number
from ..operators import bootstrap as bs
from ..operators import clinical as cl
from ..operators import cohort as coh
from ..operators import evaluate as ev
from ..operators import profile as pf
from ..operators import reshape as rs
from ..operators import temporal as tp
from ..session import pin
from ..sources import load_table

ID = "hospitalization_id"

# ---- fixed values: feature definitions -----------------------------------------------------
VITAL_CATEGORIES = ["weight_kg", "heart_rate", "sbp", "dbp", "temp_c", "height_cm"]
VITAL_RENAMES = {"heart_rate": "pulse"}
VITAL_FEATURES = ["bmi", "weight_kg", "pulse", "sbp", "dbp", "temp_c"]
LAB_CATEGORIES = ["monocytes_percent", "lymphocytes_percent", "basophils_percent", "neutrophils_percent",
                  "albumin", "ast", "total_protein", "alkaline_phosphatase", "bilirubin_total",
                  "bilirubin_conjugated", "calcium_total", "chloride", "potassium", "sodium", "glucose_serum",
                  "hemoglobin", "platelet_count", "wbc"]
LAB_RENAMES = {"monocytes_percent": "monocyte", "lymphocytes_percent": "lymphocyte",
               "basophils_percent": "basophil", "neutrophils_percent": "neutrophil", "calcium_total": "calcium"}
SUBGROUPS = ["race", "ethnicity", "sex"]

TABLES = ["adt", "hospitalization", "patient", "vitals", "labs", "respiratory_support",
          "medication_admin_continuous", "patient_assessments"]


def lab_variables() -> list[str]:
    return sorted(LAB_RENAMES.get(c, c) for c in LAB_CATEGORIES)


def model_columns() -> list[str]:
    """The 74 model inputs: 2 demographic, 18 vital (min/max/avg of six), 54 lab (min/max/mean of 18)."""
    vit = [f"{s}_{v}" for v in VITAL_FEATURES for s in ("min", "max", "avg")]
    lab = [f"{v}_{s}" for v in lab_variables() for s in ("min", "max", "mean")]
    return ["isfemale", "age"] + vit + lab


def load_registry(spark: SparkSession, root: str, fmt: str = "parquet", version: int = 2,
                  prefix: str = "", tables=TABLES) -> dict:
    return {t: load_table(spark, t, root, fmt, version=version, prefix=prefix) for t in tables}


def study_cohort(t: dict, pinned: bool = True, **rules) -> DataFrame:
    """COH-1 + COH-2: first ICU block with demographics and outcome label.  Every later
    table reads the cohort, so by default it is pinned once in the checkpoint folder."""
    c = coh.demographics(coh.first_block(t["adt"], t["hospitalization"], **rules), t["patient"])
    return pin(c) if pinned else c


def vital_features(cohort: DataFrame, vitals: DataFrame, strict: bool = True, version: int = 2) -> DataFrame:
    """FEA-1: per (id, time) pivot of the six vitals, BMI where weight and height share a
    time, then min / max / avg per id over the first window.  Version 1 charts height in
    inches (category ``height_inches``), converted to cm (x 2.54) before the pivot, and
    the pulse under its own name."""
    parse = strict_number if strict else lenient_number
    names = [*VITAL_CATEGORIES, *(["height_inches", "pulse"] if version == 1 else [])]
    # only values of the cohort's windows are parsed: others may hold anything
    inside = tp.window_join(cohort, vitals.where(F.col("vital_category").isin(*names)), id_col=ID, t="recorded_dttm")
    inside = inside.withColumn("v", parse("vital_value"))
    if version == 1:
        cat = F.col("vital_category")
        inside = inside.withColumns({"v": F.when(cat == "height_inches", F.col("v") * 2.54).otherwise(F.col("v")),
                                     "vital_category": F.when(cat == "height_inches", F.lit("height_cm"))
                                     .when(cat == "pulse", F.lit("heart_rate")).otherwise(cat)})
    wide = rs.pivot_eav(inside, keys=[ID, "recorded_dttm"], cat="vital_category", value="v",
                        categories=VITAL_CATEGORIES, names=VITAL_RENAMES)
    wide = wide.withColumn("bmi", safe_div(F.col("weight_kg"), (F.col("height_cm") / 100) * (F.col("height_cm") / 100)))
    aggs = [f(c).alias(f"{n}_{c}") for c in VITAL_FEATURES for n, f in (("min", F.min), ("max", F.max), ("avg", F.avg))]
    return cohort.select(ID).join(wide.groupBy(ID).agg(*aggs), ID, "left")


def lab_features(cohort: DataFrame, labs: DataFrame, standard_only: bool = False) -> DataFrame:
    """FEA-2: lenient parse ('>90' -> NULL), renamed categories, min / max / mean per id.
    ``standard_only`` keeps rows whose ``lab_type_name`` is 'standard' (version 1, FLT-2)."""
    labs = rs.filter_categories(labs, "lab_category", LAB_CATEGORIES,
                                type_col="lab_type_name" if standard_only else None)
    lab = (labs
           .withColumn("lab_category", F.coalesce(
               *[F.when(F.col("lab_category") == k, F.lit(v)) for k, v in LAB_RENAMES.items()], F.col("lab_category")))
           .withColumn("v", lenient_number("lab_value")))
    return rs.window_features(cohort, lab, id_col=ID, t="lab_order_dttm", cat="lab_category", value="v",
                              categories=lab_variables())


def model_matrix(cohort: DataFrame, t: dict, version: int = 2) -> DataFrame:
    """MOD-1: id, label and the 74 inputs (JON-8: per-id parts joined on the id)."""
    base = cohort.select(ID, "isfemale", "age", F.col("isdeathdispo").alias("label"), "race", "ethnicity", "sex")
    vit = vital_features(cohort, t["vitals"], version=version)
    lab = lab_features(cohort, t["labs"], standard_only=version == 1)
    m = base.join(vit, ID, "left").join(lab, ID, "left")
    return m.select(ID, "label", "race", "ethnicity", "sex", *model_columns())


def evaluation(scored: DataFrame, *, label: str = "label", score: str = "pred_proba", site: str = "site",
               thr: float = fixed.THRESHOLD, replicates: int = fixed.BOOTSTRAP_REPLICATES) -> dict:
    """EVL-2..12 for a scored cohort with a site column."""
    s = scored.withColumnsRenamed({label: "label", score: "score"})
    by = [site]
    lad = ev.score_ladder(s, by=by)
    sweep = ev.topn_sweep(s, by=by, lad=lad)
    roc = ev.roc_points(lad, by)
    return {
        "metrics": bs.metrics_table(ev.headline_metrics(s, by=by, thr=thr, lad=lad), bs.bootstrap_ci(
            s, by=by, thr=thr, replicates=replicates), by=by),
        "fairness": ev.fairness(s, subgroups=[c for c in SUBGROUPS if c in s.columns], by=by, thr=thr),
        "top_n": sweep,
        "at_threshold": ev.metrics_at_threshold(s, by=by, thr=thr),
        "calibration": ev.calibration_equal_width(s, by=by),
        "roc": roc.select(*by, "fpr", "tpr", "threshold"),
        "pr": ev.pr_points(lad, by),
        "curve_areas": ev.curve_areas(lad, by),
        "decision_curve": ev.net_benefit(sweep),
    }


def descriptive(cohort: DataFrame, t: dict) -> dict:
    """MED-1, VEN-1, VEN-2, SOF-1 and Table 1 for the cohort (T2 flow)."""
    win = cohort.select(ID, "min_in_dttm", "after_24hr")
    ids = cohort.select(ID).distinct()
    vit = t["vitals"].withColumn("vital_value", lenient_number("vital_value"))
    weights = (tp.window_join(win, vit.where(F.col("vital_category") == "weight_kg"), id_col=ID, t="recorded_dttm")
               .select(ID, "recorded_dttm", F.col("vital_value").alias("weight_kg")))
    meds = tp.window_join(win, t["medication_admin_continuous"].where(F.col("med_category").isin(*fixed.REQUIRED_MEDS)),
                          id_col=ID, t="admin_dttm")
    conv = cl.convert_doses(tp.asof_join(meds, weights, id_col=ID, left_t="admin_dttm", right_t="recorded_dttm",
                                         values=["weight_kg"]))
    total = ids.agg(F.count(F.lit(1)).alias("n_total"))
    resp = t["respiratory_support"].join(ids, ID, "left_semi")
    labs = t["labs"].withColumn("lab_value_numeric", F.coalesce(F.col("lab_value_numeric"), lenient_number("lab_value")))
    gcs = t["patient_assessments"].where(F.col("assessment_category") == "gcs_total")
    sofa = cl.organ_score(win, id_col=ID, vitals=vit, resp=resp, labs=labs, gcs=gcs, meds=conv)
    vent = cl.ventilated_ids(resp, id_col=ID)
    people = coh.membership_flag(cohort, vent, ID, "Ventilator").withColumnRenamed(
        "isdeathdispo", "Mortality")
    return {
        "meds": cl.dose_summary(conv, total, id_col=ID),
        "peep_fio2": cl.settings_summary(win, resp, id_col=ID),
        "modes": cl.initial_modes(resp, ids, id_col=ID),
        "sofa": sofa,
        "sofa_distribution": cl.organ_score_distribution(sofa, id_col=ID),
        "table1": pf.table1(people, continuous=["age", "ICU_stay_hrs"],
                            categorical=["sex", "race", "ethnicity", "Mortality", "Ventilator"]),
    }
