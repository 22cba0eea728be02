"""Spark side of the query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per
inventory item, built only from vigil operators over the analogue tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cohort as coh
from .analogues import Analogue

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _cohort(a: Analogue) -> DataFrame:
    """The analogue cohort: first ICU block, 48 h entry, 72 h horizon, 24 h minimum,
    admissions in 2024, adults."""
    return coh.first_block(a.stays(), a.encounters(), tie="event_id",
                           admit_from="2024-01-01", admit_before="2025-01-01", min_age=18)


@query
def q_first_block(spark, d):
    return _cohort(Analogue(spark, d)).select(
        "hospitalization_id", "patient_id", "age", "dispo", "min_in_dttm", "max_out_dttm",
        "after_24hr")


@query
def q_state_blocks(spark, d):
    a = Analogue(spark, d)
    s = a.stays().withColumn("location_category", coh.normalise_state("location_category"))
    return coh.state_blocks(s, tie="event_id", merge={"OR": "ICU"}).select(
        "hospitalization_id", F.col("block").cast("long").alias("block"), "location_category",
        "min_in_dttm", "max_out_dttm", "n_rows")


@query
def q_cohort_demographics(spark, d):
    a = Analogue(spark, d)
    df = coh.demographics(_cohort(a), a.patients(), death_pattern="urgent|high")
    return df.select("hospitalization_id", "patient_id", "age", "dispo", "min_in_dttm",
                     "max_out_dttm", "after_24hr", "sex", "isfemale", "isdeathdispo", "race",
                     "ethnicity", r6("ICU_stay_hrs").alias("ICU_stay_hrs"))


# ---- features -------------------------------------------------------------------------
from ..functions import lenient_number, safe_div, trunc_ntz  # noqa: E402
from ..operators import reshape as rs  # noqa: E402
from ..operators import temporal as tp  # noqa: E402

OBS_CATEGORIES = ["view", "purchase", "signup", "click", "error", "temp_c"]


@query
def q_window_features_wide(spark, d):
    a = Analogue(spark, d)
    obs = a.observations().withColumn("v", lenient_number("vital_text"))
    f = rs.window_features(_cohort(a), obs, id_col="hospitalization_id", t="recorded_dttm",
                           cat="vital_category", value="v", categories=OBS_CATEGORIES, tie="event_id")
    return f.select("hospitalization_id", *[
        (r6(c).alias(c) if c.endswith("_mean") else c) for c in f.columns if c != "hospitalization_id"])


@query
def q_ratio_at_same_time(spark, d):
    a = Analogue(spark, d)
    obs = a.observations().withColumn("recorded_dttm", trunc_ntz("DAY", "recorded_dttm"))
    w = rs.pivot_eav(obs, keys=["hospitalization_id", "recorded_dttm"], cat="vital_category",
                     value="vital_value", categories=["view", "click"], tie="event_id",
                     names={"view": "weight_kg", "click": "height_cm"})
    bmi = safe_div(F.col("weight_kg"), (F.col("height_cm") / 100.0) * (F.col("height_cm") / 100.0))
    return w.select("hospitalization_id", "recorded_dttm", "weight_kg", "height_cm",
                    r6(bmi).alias("bmi"))


WORST_RANGES = {"view": (0.0, 400.0), "error": (1.0, 450.0), "click": (5.0, 500.0)}


@query
def q_range_filtered_worst(spark, d):
    a = Analogue(spark, d)
    return rs.worst_values(a.observations(), id_col="hospitalization_id", t="recorded_dttm",
                           cat="vital_category", value="vital_value",
                           worst_max=["view", "error"], worst_min=["click", "purchase"],
                           ranges=WORST_RANGES, floors={"purchase": 10.0})


@query
def q_asof_weight(spark, d):
    a = Analogue(spark, d)
    j = tp.asof_join(a.doses(), a.weights(), id_col="hospitalization_id", left_t="admin_dttm",
                     right_t="recorded_dttm", values=["weight_kg", "w_event_id"],
                     right_tie="w_event_id", bucket="DAY")
    # the matched id may be NULL: exported as text so both engines agree on the type
    return j.withColumn("w_event_id", F.col("w_event_id").cast("string"))


@query
def q_asof_weight_swapped(spark, d):
    a = Analogue(spark, d)
    j = tp.asof_join(a.weights(), a.doses(), id_col="hospitalization_id", left_t="recorded_dttm",
                     right_t="admin_dttm", values=["med_category", "med_dose", "med_dose_unit", "event_id"],
                     right_tie="event_id", bucket="DAY")
    return j.withColumn("event_id", F.col("event_id").cast("string"))


# ---- evaluation of scored cases ----------------------------------------------------------
from ..operators import evaluate as ev  # noqa: E402

SITE = ["site"]


def _scored(spark, d):
    return Analogue(spark, d).scored()


@query
def q_score_ladder(spark, d):
    return ev.score_ladder(_scored(spark, d), by=SITE).drop("next_pos", "next_neg")


@query
def q_roc_points(spark, d):
    lad = ev.score_ladder(_scored(spark, d), by=SITE)
    return ev.roc_points(lad, SITE).select("site", "fpr", "tpr", "threshold")


@query
def q_pr_points(spark, d):
    lad = ev.score_ladder(_scored(spark, d), by=SITE)
    return ev.pr_points(lad, SITE)


@query
def q_threshold_metrics_all(spark, d):
    lad = ev.score_ladder(_scored(spark, d), by=SITE)
    return ev.threshold_metrics(ev.roc_points(lad, SITE), SITE)


@query
def q_metrics_at_threshold(spark, d):
    return ev.metrics_at_threshold(_scored(spark, d), by=SITE)


@query
def q_auc_brier(spark, d):
    m = ev.headline_metrics(_scored(spark, d), by=SITE)
    return m.select("site", "metric", r6("value").alias("value"))


def _sweep(spark, d):
    return ev.topn_sweep(_scored(spark, d), by=SITE)


@query
def q_topn_sweep(spark, d):
    s = _sweep(spark, d)
    return s.select("site", "q", "n_percentile", r6("thr_value").alias("thr_value"), "tn", "fp", "fn", "tp",
                    *[r6(c).alias(c) for c in ("sensitivity", "specificity", "ppv", "npv", "recall",
                                              "accuracy")])


@query
def q_calibration_equal_width(spark, d):
    c = ev.calibration_equal_width(_scored(spark, d), by=SITE)
    return c.select("site", "bin", "n", *[r6(x).alias(x) for x in ("predicted_prob", "actual_prob", "se",
                                                                   "lower_ci", "upper_ci")])


@query
def q_calibration_fixed_edges(spark, d):
    c = ev.calibration_fixed_edges(_scored(spark, d), by=SITE)
    return c.select("site", "prob_bin_val", "n", r6("actual_prob").alias("actual_prob"),
                    r6("predicted_prob").alias("predicted_prob"))


@query
def q_fairness(spark, d):
    f = ev.fairness(_scored(spark, d), subgroups=["priority", "segment"], by=SITE)
    keep = ["site", "subgroup", "group_value", "tn", "tp", "fp", "fn", "group_count", "total_count"]
    return f.select(*keep, *[r6(c).alias(c) for c in f.columns if c not in keep])


@query
def q_net_benefit(spark, d):
    nb = ev.net_benefit(_sweep(spark, d))
    return nb.select("site", "q", r6("thr_value").alias("thr_value"), r6("net_benefit").alias("net_benefit"))


@query
def q_nearest_threshold(spark, d):
    nb = ev.net_benefit(_sweep(spark, d)).select("site", "q", "thr_value", "net_benefit")
    n = ev.nearest_threshold(nb, SITE)
    return n.select("site", "q", r6("thr_value").alias("thr_value"), r6("net_benefit").alias("net_benefit"))


@query
def q_calibration_slope(spark, d):
    c = ev.calibration_equal_width(_scored(spark, d), by=SITE)
    g = c.groupBy("site").agg(F.regr_slope("actual_prob", "predicted_prob").alias("slope"),
                              F.regr_intercept("actual_prob", "predicted_prob").alias("intercept"))
    return g.select("site", r6("slope").alias("slope"), r6("intercept").alias("intercept"))


@query
def q_site_table(spark, d):
    from ..operators import sites
    m = ev.headline_metrics(_scored(spark, d), by=SITE)
    t = sites.site_table(m)
    return t.select("site", r6("auc").alias("auc"), r6("brier").alias("brier"), "auc_rank", "brier_rank")


# ---- clinical summaries --------------------------------------------------------------------
from ..operators import clinical as cl  # noqa: E402

ID = "hospitalization_id"


def _converted(a: Analogue) -> DataFrame:
    j = tp.asof_join(a.doses(), a.weights(), id_col=ID, left_t="admin_dttm", right_t="recorded_dttm",
                     values=["weight_kg", "w_event_id"], right_tie="w_event_id", bucket="DAY")
    return cl.convert_doses(j)


@query
def q_dose_converted(spark, d):
    c = _converted(Analogue(spark, d))
    return c.select(ID, "admin_dttm", "event_id", "med_category", "med_dose", "med_dose_unit", "weight_kg",
                    "med_dose_converted")


@query
def q_dose_summary(spark, d):
    a = Analogue(spark, d)
    total = a.table("events").agg(F.count_distinct("user_id").alias("n_total"))
    s = cl.dose_summary(_converted(a), total, id_col=ID)
    # NULL for a required drug never given: a nullable count is exported as double
    return s.select("med_category", F.col("n_encounters").cast("double").alias("n_encounters"),
                    *[r6(c).alias(c) for c in ("overall_median_dose", "overall_iqr_lower", "overall_iqr_upper",
                                               "pct_encounters")])


@query
def q_settings_summary(spark, d):
    a = Analogue(spark, d)
    s = cl.settings_summary(a.order_windows(), a.settings(), id_col=ID)
    return s.select(*[r6(c).alias(c) for c in s.columns])


@query
def q_initial_mode_table(spark, d):
    a = Analogue(spark, d)
    t = cl.initial_modes(a.settings(), a.order_windows(), id_col=ID, tie=["l_linenumber"])
    return t.select("denominator", "mode_category", F.col("n_encounters").cast("double").alias("n_encounters"),
                    r6("pct_encounters").alias("pct_encounters"))


def _sofa(spark, d):
    a = Analogue(spark, d)
    return cl.organ_score(a.order_windows(), id_col=ID, **a.sofa_inputs())


@query
def q_organ_score(spark, d):
    s = _sofa(spark, d)
    return s.select(ID, *[r6(c).alias(c) for c in ("p_f", "p_f_imputed", "s_f")], "resp_support_max",
                    "sofa_cv_97", "sofa_coag", "sofa_liver", "sofa_renal", "sofa_resp_pf", "sofa_resp_pf_imp",
                    "sofa_resp", "sofa_cns", "sofa_97_24hr")


@query
def q_organ_score_distribution(spark, d):
    s = cl.organ_score_distribution(_sofa(spark, d), id_col=ID)
    return s.select("sofa_category", *[r6(c).alias(c) for c in ("overall_median", "overall_iqr_lower",
                                                                 "overall_iqr_upper")])


# ---- profiling -------------------------------------------------------------------------------
from ..functions import fixed as fx  # noqa: E402
from ..functions import map_values, death_flag  # noqa: E402
from ..operators import profile as pf  # noqa: E402

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def q_describe_features(spark, d):
    li = Analogue(spark, d).table("lineitem")
    t = pf.transpose_stats(pf.describe(li, LINE_FEATURES), LINE_FEATURES)
    return t.select("statistic", *[r6(c).alias(c) for c in LINE_FEATURES])


@query
def q_missingness(spark, d):
    s = Analogue(spark, d).settings()
    m = pf.missingness(s, ["device_category", "mode_category", "fio2_set", "peep_set", "tidal_volume_set",
                           "lpm_set"])
    return m.select("column", "na_count", "total_rows", r6("nan_percentage").alias("nan_percentage"))


@query
def q_histogram30(spark, d):
    h = pf.histogram(Analogue(spark, d).table("lineitem"), LINE_FEATURES, bins=30)
    return h.select("feature", "bin", "n", r6("bin_lower").alias("bin_lower"))


def _people(a: Analogue) -> DataFrame:
    e = a.encounters().join(a.patients(), "patient_id", "left")
    return e.select("hospitalization_id", "age_at_admission", F.col("sex_category").alias("sex"),
                    map_values("race_category", fx.RACE_MAP, fx.RACE_DEFAULT).alias("race"),
                    map_values("ethnicity_category", fx.ETHNICITY_MAP, fx.ETHNICITY_DEFAULT).alias("ethnicity"),
                    death_flag("discharge_category", "urgent|high").alias("Mortality"))


@query
def q_table1(spark, d):
    t = pf.table1(_people(Analogue(spark, d)), continuous=["age_at_admission"],
                  categorical=["sex", "race", "ethnicity", "Mortality"])
    return t.select("variable", "level", "statistic", r6("value").alias("value"))


# ---- small relational operators ----------------------------------------------------------
SITE_NAMES = {"AFRICA": "Africa Region", "AMERICA": "Americas Region", "ASIA": "Asia Region",
              "EUROPE": "Europe Region"}


@query
def q_split_tag(spark, d):
    s = _scored(spark, d)
    tag = F.when(F.col("year").isin(1998, 1999), F.lit("test")).otherwise(F.lit("train"))
    return s.select("case_id", "year", tag.alias("Data_Type"))


@query
def q_lookup_map(spark, d):
    s = _scored(spark, d)
    return s.select("case_id", "site", map_values("site", SITE_NAMES, None).alias("site_name"))


@query
def q_membership_flag(spark, d):
    a = Analogue(spark, d)
    vent = cl.ventilated_ids(a.settings(), id_col=ID)
    return coh.membership_flag(a.order_windows().select(ID), vent, ID, "Ventilator")


# ---- bootstrap and model (random / fitted: rows-only checks) ---------------------------------
from ..operators import bootstrap as bs  # noqa: E402
from ..operators import model as mdl  # noqa: E402


@query
def q_bootstrap_ci(spark, d):
    ci = bs.bootstrap_ci(_scored(spark, d), by=SITE, replicates=1000, seed=42)
    return ci.select("site", "metric", r6("ci_lower").alias("ci_lower"), r6("ci_upper").alias("ci_upper"), "replicates")


@query
def q_metrics_table(spark, d):
    s = _scored(spark, d)
    t = bs.metrics_table(ev.headline_metrics(s, by=SITE), bs.bootstrap_ci(s, by=SITE), by=SITE)
    return t.select("site", "metric", *[r6(c).alias(c) for c in ("value", "ci_lower", "ci_upper")])


def _site_files(spark, d) -> str:
    """The metrics table as one CSV per site, as the sites would send them; every other site orders its columns its own way."""
    from ..session import shared_path, written
    from ..sources import write_site_files
    path = shared_path(spark, "site-files")
    t = written(q_metrics_table(spark, d), "site-metrics")  # both writes read it
    write_site_files(t, f"{path}/a", "site")
    write_site_files(t.where(F.substring("site", 1, 1) == "A").select("ci_upper", "metric", "site", "ci_lower", "value"), f"{path}/b", "site")
    return path


@query
def q_site_table_from_files(spark, d):
    """SNK-1, SRC-6, SET-1, JON-10, EVL-16: one file per site, read back by header, named, ranked, with intervals."""
    from ..operators import sites
    from ..sources import read_site_results
    from ..streaming.site_results import METRICS_SCHEMA
    path = _site_files(spark, d)
    rows = read_site_results(spark, f"{path}/*/*/*.csv", METRICS_SCHEMA).distinct()
    t = sites.site_table(rows, lower="ci_lower", upper="ci_upper")
    return t.select(map_values("site", SITE_NAMES, None).alias("site_name"), "site", "auc", "auc_ci_lower", "auc_ci_upper", "brier",
                    "auc_rank", "brier_rank")


MODEL_FEATURES = ["o_totalprice", "c_acctbal", "c_nationkey", "priority_rank", "n_lines", "avg_discount",
                  "sum_quantity", "max_tax", "open_lines"]


def _model_frame(spark, d):
    a = Analogue(spark, d)
    o, c, li = a.table("orders"), a.table("customer"), a.table("lineitem")
    lines = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.avg("l_discount").alias("avg_discount"),
                                         F.sum("l_quantity").alias("sum_quantity"), F.max("l_tax").alias("max_tax"),
                                         F.sum((F.col("l_linestatus") == "O").cast("int")).alias("open_lines"))
    return (o.join(c, o.o_custkey == c.c_custkey, "left").join(lines, o.o_orderkey == lines.l_orderkey, "left")
            .select(F.col("o_orderkey").cast("string").alias("case_id"),
                    (F.col("o_orderstatus") == "F").cast("int").alias("label"),
                    F.year("o_orderdate").alias("year"), "o_totalprice", "c_acctbal", "c_nationkey",
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("priority_rank"),
                    "n_lines", "avg_discount", "sum_quantity", "max_tax", "open_lines"))


def _fit(spark, d):
    """(model fitted on the other years, rows of the test years).  Fitting reads its rows several times (medians, labels,
    splits, tree points), so the joined frame is written once, which also deals the rows to as many tasks as there are cores."""
    from ..session import written
    df = written(_model_frame(spark, d), "model-frame")
    test = F.col("year").isin(1998, 1999)
    return mdl.train(df.where(~test), MODEL_FEATURES), df.where(test)


@query
def q_gbt_scores(spark, d):
    model, test = _fit(spark, d)
    return mdl.score(model, test, MODEL_FEATURES).select("case_id", "label", "pred_proba")


@query
def q_gbt_importance(spark, d):
    model, _ = _fit(spark, d)
    return mdl.importance(model, MODEL_FEATURES, top=20)


@query
def q_curve_areas(spark, d):
    lad = ev.score_ladder(_scored(spark, d), by=SITE)
    a = ev.curve_areas(lad, SITE)
    return a.select("site", r6("roc_auc_trapezoid").alias("roc_auc_trapezoid"), r6("pr_auc").alias("pr_auc"))


@query
def q_label_probability_table(spark, d):
    return _scored(spark, d).select("case_id", "label", F.col("score").alias("pred_proba"), "site")


@query
def q_gbt_split_counts(spark, d):
    model, _ = _fit(spark, d)
    return mdl.split_counts(model, MODEL_FEATURES, top=20)


@query
def q_curve_areas_interpolated(spark, d):
    lad = ev.score_ladder(_scored(spark, d), by=SITE)
    a = ev.curve_areas(lad, SITE, pr="interpolated")
    return a.select("site", r6("pr_auc").alias("pr_auc_interpolated"))


# A category or unit that the study does not know ends each list; a line of a supplier divisible by 17 has no unit.
_LAB_NAMES = [c for c, _ in fx.LAB_UNITS] + ["lactate"]
_LAB_UNIT_NAMES = sorted({u for _, u in fx.LAB_UNITS}) + ["g/L"]


@query
def q_lab_standard_units(spark, d):
    li = Analogue(spark, d).table("lineitem")
    pick = lambda names, at: F.get(F.array(*map(F.lit, names)), (at % len(names)).cast("int"))
    labs = li.select(pick(_LAB_NAMES, F.col("l_partkey")).alias("lab_category"),
                     F.when(F.col("l_suppkey") % 17 != 0, pick(_LAB_UNIT_NAMES, F.col("l_orderkey"))).alias("reference_unit"),
                     F.when(F.col("l_linestatus") == "O", F.lit("standard")).otherwise(F.lit("poc")).alias("lab_type_name"),
                     F.col("l_quantity").alias("lab_value"))
    return rs.standard_labs(labs).groupBy("lab_category", "reference_unit").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("lab_value")).alias("mean_value"))


# Labs analogue for the category / unit / type filters: lineitem lines as lab results.
LAB_PAIRS = [("creatinine", "mg/dL"), ("albumin", "g/dL"), ("sodium", "mmol/L")]


@query
def q_lab_unit_filter(spark, d):
    li = Analogue(spark, d).table("lineitem")
    cat = (F.when(F.col("l_returnflag") == "R", F.lit("creatinine")).when(F.col("l_returnflag") == "A", F.lit("albumin"))
           .otherwise(F.lit("sodium")))
    unit = (F.when(F.col("l_linenumber") % 3 == 0, F.lit("mg/dL")).when(F.col("l_linenumber") % 3 == 1, F.lit("g/dL"))
            .otherwise(F.lit("mmol/L")))
    typ = F.when(F.col("l_linestatus") == "O", F.lit("standard")).otherwise(F.lit("poc"))
    labs = li.select(F.col("l_orderkey").cast("string").alias(ID), cat.alias("lab_category"),
                     unit.alias("reference_unit"), typ.alias("lab_type_name"), F.col("l_quantity").alias("lab_value"))
    std = rs.filter_categories(labs, "lab_category", ["creatinine", "albumin"], type_col="lab_type_name")
    kept = rs.filter_pairs(std, LAB_PAIRS, ["lab_category", "reference_unit"])
    return kept.groupBy("lab_category", "reference_unit").agg(F.count(F.lit(1)).alias("n"),
                                                              r6(F.avg("lab_value")).alias("mean_value"))


@query
def q_table1_header(spark, d):
    s = _scored(spark, d)
    return pf.table1_header(s, "site")


@query
def q_source_scan(spark, d):
    """SRC-2/3/5: the format-dispatching loader over a driver table, with projection and a
    filter that reach the parquet scan."""
    from ..sources import load_table
    o = load_table(spark, "orders", d, "parquet")
    return (o.where(F.col("o_orderstatus") == "F").select("o_orderpriority", "o_totalprice")
            .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"),
                                            F.round(F.sum("o_totalprice"), 2).alias("total_price")))


@query
def q_bootstrap_poisson_ci(spark, d):
    b = bs.poisson_bootstrap_ci(_scored(spark, d), id_col="case_id", by=SITE, replicates=20, seed=42)
    return b.select("site", "metric", r6("ci_lower").alias("ci_lower"), r6("ci_upper").alias("ci_upper"))


# ---- the configured study: feature tables and the model matrix -------------------------------
from . import registry as reg  # noqa: E402


def _rounded(df, keep):
    return df.select(*[c if c in keep else r6(c).alias(c) for c in df.columns])


@query
def q_vital_features(spark, d):
    """FEA-1: the 18 vital inputs, BMI where weight and height share a time."""
    a = Analogue(spark, d)
    return _rounded(reg.vital_features(_cohort(a), a.registry_vitals(reg.VITAL_CATEGORIES)), [reg.ID])


@query
def q_lab_features(spark, d):
    """FEA-2: the 54 lab inputs."""
    a = Analogue(spark, d)
    return _rounded(reg.lab_features(_cohort(a), a.registry_labs(reg.LAB_CATEGORIES)), [reg.ID])


@query
def q_model_matrix(spark, d):
    """MOD-1: id, label, subgroups and the 74 inputs."""
    a = Analogue(spark, d)
    cohort = coh.demographics(_cohort(a), a.patients(), death_pattern="urgent|high")
    t = {"vitals": a.registry_vitals(reg.VITAL_CATEGORIES), "labs": a.registry_labs(reg.LAB_CATEGORIES)}
    return _rounded(reg.model_matrix(cohort, t), [reg.ID, "label", "race", "ethnicity", "sex", "isfemale"])


@query
def q_model_missingness(spark, d):
    """AGG-13 over the model matrix: one row per input."""
    return pf.missingness(q_model_matrix(spark, d), reg.model_columns())
