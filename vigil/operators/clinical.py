"""Clinical summaries: dose conversion (JON-12, CND-6, MED-1), ventilator settings and
initial modes (VEN-1/2), and the organ failure score (SOF-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, pao2_from_spo2, first_nonblank
from ..session import written
from .ordered import quantile_columns
from .reshape import densify
from .temporal import first_per_key, window_join

IQR = {"median": 0.5, "q25": 0.25, "q75": 0.75}


# ---- doses --------------------------------------------------------------------------------
def dose_factors(spark) -> DataFrame:
    """The 36-row (drug, unit) -> factor table; a fixed literal, so broadcasting it is safe."""
    return spark.createDataFrame(fixed.dose_factor_rows(),
                                 "_drug string, _unit string, _factor double, _per_weight boolean")


def convert_doses(df: DataFrame, *, drug: str = "med_category", unit: str = "med_dose_unit",
                  dose: str = "med_dose", weight: str = "weight_kg", out: str = "med_dose_converted",
                  digits: int = 3) -> DataFrame:
    """CND-6: dose in the drug's target unit, rounded to ``digits``.  Units are compared
    in lower case; an unknown (drug, unit) pair, or a per-minute dose without a weight,
    gives NULL.  Rows without a dose are dropped."""
    ft = F.broadcast(dose_factors(df.sparkSession))
    x = (df.where(F.col(dose).isNotNull()).withColumn("_u", F.lower(unit))
         .join(ft, (F.col(drug) == F.col("_drug")) & (F.col("_u") == F.col("_unit")), "left"))
    eff = F.when(F.col("_per_weight"), F.try_divide(F.col("_factor"), F.col(weight))).otherwise(F.col("_factor"))
    return (x.withColumn(out, F.round(F.col(dose) * eff, digits))
            .withColumn("conversion_factor", eff)
            .drop("_u", "_drug", "_unit", "_factor", "_per_weight"))


def dose_summary(conv: DataFrame, total: DataFrame, *, id_col: str, drug: str = "med_category",
                 value: str = "med_dose_converted", required: Sequence[str] = tuple(fixed.REQUIRED_MEDS)) -> DataFrame:
    """MED-1: per encounter and drug the median / quartiles of the converted dose; per
    drug the median and quartiles of the encounter medians leaving out zeros (paused
    infusions), the number and percent of encounters (of ``total``, a one-row frame with
    ``n_total``) and one row per required drug (NULL row when never given)."""
    # one row per (encounter, drug) given, NULL quantiles when no dose converted: a group is one encounter's
    # charting of one drug, so the built-in holds its values; the rows serve both steps below from one table
    enc = written(conv.groupBy(id_col, drug).agg(*[F.percentile(value, p).alias(name) for name, p in IQR.items()]), "doses")
    overall = quantile_columns(enc.where(F.col("median") != 0), [drug], "median",
                               {"overall_median_dose": 0.5, "overall_iqr_lower": 0.25,
                                "overall_iqr_upper": 0.75})
    counts = enc.groupBy(drug).agg(F.count(F.lit(1)).alias("n_encounters"))
    agg = (counts.join(overall, drug, "left").crossJoin(F.broadcast(total))
           .withColumn("pct_encounters", F.try_divide(100.0 * F.col("n_encounters"), F.col("n_total"))).drop("n_total"))
    return densify(agg, list(required), drug)


# ---- ventilation --------------------------------------------------------------------------
def ventilated_ids(resp: DataFrame, *, id_col: str, device: str = "device_category",
                   devices: Sequence[str] = tuple(fixed.VENTILATED_DEVICES)) -> DataFrame:
    """Ids with any row on invasive ventilation ('IMV' in v2, 'Vent' in v1)."""
    return resp.where(F.col(device).isin(*devices)).select(id_col).distinct()


def clean_fio2(resp: DataFrame, *, fio2: str = "fio2_set") -> DataFrame:
    """AGG-15: FiO2 in percent (global mean > 1) is divided by 100; FiO2 outside 0.21..1 becomes
    NULL (rows kept).  The mean is a one-row aggregate broadcast to every row."""
    mean = resp.agg(F.avg(fio2).alias("_fio2_mean"))
    f = F.when(F.col("_fio2_mean") > 1, F.col(fio2) / 100.0).otherwise(F.col(fio2))
    return (resp.crossJoin(F.broadcast(mean)).withColumn(fio2, f).drop("_fio2_mean")
            .withColumn(fio2, F.when(F.col(fio2).between(*fixed.FIO2_RANGE), F.col(fio2))))


def clean_settings(resp: DataFrame, *, fio2: str = "fio2_set", peep: str = "peep_set") -> DataFrame:
    """AGG-15 + FLT-10: :func:`clean_fio2`, and PEEP outside 0..30 becomes NULL."""
    return clean_fio2(resp, fio2=fio2).withColumn(peep, F.when(F.col(peep).between(*fixed.PEEP_RANGE), F.col(peep)))


def settings_summary(windows: DataFrame, resp: DataFrame, *, id_col: str, t: str = "recorded_dttm",
                     lo: str = "min_in_dttm", hi: str = "after_24hr") -> DataFrame:
    """VEN-1: median and quartiles of PEEP and FiO2 over the first-window rows of
    ventilated encounters (one row)."""
    vent = ventilated_ids(resp, id_col=id_col)
    r = clean_settings(resp.join(vent, id_col, "left_semi"))
    inside = window_join(windows, r, id_col=id_col, t=t, lo=lo, hi=hi)
    long = inside.select(F.lit(1).alias("_k"), "peep_set", "fio2_set").unpivot(
        ["_k"], ["peep_set", "fio2_set"], "setting", "v")
    q = quantile_columns(long, ["setting"], "v", IQR)
    row = q.groupBy().agg(*[F.max(F.when(F.col("setting") == s, F.col(c))).alias(f"{n}_{s.split('_')[0]}")
                            for s in ("peep_set", "fio2_set")
                            for c, n in (("median", "median"), ("q25", "iqr_lower"), ("q75", "iqr_upper"))])
    return row


def initial_modes(resp: DataFrame, encounters: DataFrame, *, id_col: str, t: str = "recorded_dttm",
                  tie: Sequence[str] = (), mode: str = "mode_category",
                  required: Sequence[str] = tuple(fixed.REQUIRED_MODES)) -> DataFrame:
    """VEN-2: first documented (non-blank) mode per ventilated encounter, counted per
    required mode (matched case-insensitively to its listed spelling; unlisted modes count
    as undocumented), as percent of ventilated encounters and of all ``encounters``; a
    "No mode documented" row and a "Total" row close each table.
    Columns: denominator ('ventilated' | 'all'), mode_category, n_encounters, pct_encounters."""
    vent = ventilated_ids(resp, id_col=id_col)
    r = (resp.join(vent, id_col, "left_semi")
         .withColumn(mode, first_nonblank(mode)).where(F.col(mode).isNotNull()))
    first = first_per_key(r.select(id_col, t, *tie, mode), id_col, [t, *tie])
    canon = None
    for m in required:
        e = F.lower(F.col(mode)) == F.lit(m.lower())
        canon = F.when(e, F.lit(m)) if canon is None else canon.when(e, F.lit(m))
    counts = (first.withColumn(mode, canon).where(F.col(mode).isNotNull())
              .groupBy(mode).agg(F.count(F.lit(1)).alias("n_encounters")))
    # both denominators in ONE scalar row (a one-row broadcast), then unpivoted so every
    # later step runs once for both tables
    dens = (vent.agg(F.count(F.lit(1)).alias("ventilated"))
            .crossJoin(encounters.select(id_col).distinct().agg(F.count(F.lit(1)).alias("all"))))
    base = (densify(counts, list(required), mode).crossJoin(F.broadcast(dens))
            .unpivot([mode, "_order", "n_encounters"], ["ventilated", "all"], "denominator", "_d")
            .withColumn("pct_encounters", F.try_divide(100.0 * F.col("n_encounters"), F.col("_d"))))
    rest = (base.groupBy("denominator", "_d").agg(F.sum("n_encounters").alias("_s"))
            .select("denominator", F.lit(fixed.NO_MODE).alias(mode), F.lit(len(required)).alias("_order"),
                    (F.col("_d") - F.coalesce("_s", F.lit(0))).alias("n_encounters"), "_d")
            .withColumn("pct_encounters", F.try_divide(100.0 * F.col("n_encounters"), F.col("_d"))))
    cols = ["denominator", mode, "_order", "n_encounters", "pct_encounters"]
    body = base.select(*cols).unionByName(rest.select(*cols))
    total = (body.groupBy("denominator").agg(F.sum("n_encounters").alias("n_encounters"),
                                             F.sum("pct_encounters").alias("pct_encounters"))
             .select("denominator", F.lit("Total").alias(mode), F.lit(len(required) + 1).alias("_order"),
                     "n_encounters", "pct_encounters"))
    return body.unionByName(total)


# ---- organ failure score --------------------------------------------------------------------
def impute_device(device: str = "device_category", mode: str = "mode_category", fio2: str = "fio2_set",
                  lpm: str = "lpm_set", peep: str = "peep_set", tv: str = "tidal_volume_set") -> Column:
    """CND-4: fill a missing device from the other settings.  The high-flow rule for a
    nasal cannula above 20 L/min is applied first so that it can fire."""
    d, f, l = F.col(device), F.col(fio2), F.col(lpm)
    others_null = F.col(peep).isNull() & F.col(tv).isNull()
    return (F.when((d == "Nasal Cannula") & f.isNull() & (l > 20), F.lit("High Flow NC"))
            .when(d.isNotNull(), d)
            .when(F.lower(F.col(mode)).isin(*fixed.VENT_MODES_FOR_DEVICE), F.lit("Vent"))
            .when((f == 0.21) & l.isNull() & others_null, F.lit("Room Air"))
            .when(f.isNull() & (l == 0) & others_null, F.lit("Room Air"))
            .when(f.isNull() & (l <= 20) & (l > 0) & others_null, F.lit("Nasal Cannula"))
            .when(f.isNull() & (l > 20) & others_null, F.lit("High Flow NC")))


def impute_fio2(device: str = "device_category", fio2: str = "fio2_set", lpm: str = "lpm_set") -> Column:
    """CND-4: room air 0.21; nasal cannula 0.24 + 0.04 per L/min."""
    return (F.when(F.col(fio2).isNotNull(), F.col(fio2))
            .when(F.col(device) == "Room Air", F.lit(0.21))
            .when(F.col(device) == "Nasal Cannula", F.lit(0.24) + F.lit(0.04) * F.col(lpm)))


def device_rank(device: str) -> Column:
    """CND-5: 1 = Vent (also 'IMV') ... 9 = Room Air."""
    d = F.when(F.col(device) == "IMV", F.lit("Vent")).otherwise(F.col(device))
    e = None
    for i, name in enumerate(fixed.DEVICE_RANK, start=1):
        e = F.when(d == name, F.lit(i)) if e is None else e.when(d == name, F.lit(i))
    return e


def rank_device(rank: str) -> Column:
    e = None
    for i, name in enumerate(fixed.DEVICE_RANK, start=1):
        e = F.when(F.col(rank) == i, F.lit(name)) if e is None else e.when(F.col(rank) == i, F.lit(name))
    return e


def sofa_components() -> dict:
    """CND-3: the six component bands (fixed cut points), each 0 when its inputs are NULL."""
    c = F.col
    adv = c("resp_support_max").isin("NIPPV", "CPAP", "Vent")

    def band(x, cuts, strict_lt=True):
        e = None
        for thr, score in cuts:
            cond = (c(x) < thr) if strict_lt else (c(x) >= thr)
            e = F.when(cond, F.lit(score)) if e is None else e.when(cond, F.lit(score))
        return e.otherwise(F.lit(0))

    def resp(x):
        return (F.when((c(x) < 100) & adv, 4).when((c(x) < 200) & adv, 3)
                .when(c(x) < 300, 2).when(c(x) < 400, 1).otherwise(0))

    return {
        "sofa_cv_97": (F.when((c("dopamine") > 15) | (c("epinephrine") > 0.1) | (c("norepinephrine") > 0.1), 4)
                       .when((c("dopamine") > 5) | ((c("epinephrine") <= 0.1) & (c("epinephrine") > 0))
                             | ((c("norepinephrine") <= 0.1) & (c("norepinephrine") > 0)), 3)
                       .when(((c("dopamine") <= 5) & (c("dopamine") > 0)) | (c("dobutamine") > 0), 2)
                       .when(c("map_min") < 70, 1).otherwise(0)),
        "sofa_coag": band("platelet_count_min", [(20, 4), (50, 3), (100, 2), (150, 1)]),
        "sofa_liver": band("bilirubin_total_max", [(12.0, 4), (6.0, 3), (2.0, 2), (1.2, 1)], strict_lt=False),
        "sofa_renal": band("creatinine_max", [(5.0, 4), (3.5, 3), (2.0, 2), (1.2, 1)], strict_lt=False),
        "sofa_resp_pf": resp("p_f"),
        "sofa_resp_pf_imp": resp("p_f_imputed"),
        "sofa_cns": (F.when(c("min_gcs_score") < 6, 4)
                     .when((c("min_gcs_score") >= 6) & (c("min_gcs_score") <= 9), 3)
                     .when((c("min_gcs_score") >= 10) & (c("min_gcs_score") <= 12), 2)
                     .when((c("min_gcs_score") >= 13) & (c("min_gcs_score") <= 14), 1).otherwise(0)),
    }


def organ_score(windows: DataFrame, *, id_col: str, vitals: DataFrame, resp: DataFrame, labs: DataFrame,
                gcs: DataFrame, meds: DataFrame, lo: str = "min_in_dttm", hi: str = "after_24hr") -> DataFrame:
    """SOF-1: worst values inside each window, P/F, imputed P/F and S/F ratios, the six
    components and their sum.  Inputs (long): vitals (id, recorded_dttm, vital_category,
    vital_value); resp (settings columns); labs (id, lab_order_dttm, lab_category,
    lab_value_numeric); gcs (id, recorded_dttm, numerical_value); meds (id, admin_dttm,
    med_category, med_dose_converted).  The inputs are narrowed to (id, time, code, value), plausible values only, and
    meet the windows in one join; the worst of every code is one aggregate over the join's own partitions, so a value is
    shuffled once and the windows twice, whatever the number of inputs."""
    w = windows.select(id_col, lo, hi)
    drugs = ["dopamine", "epinephrine", "norepinephrine", "dobutamine"]
    labs_of = [*fixed.LABS_WORST_IS_MAX, *fixed.LABS_WORST_IS_MIN]
    codes = ["spo2", "map", *labs_of, "gcs", *drugs, "device", "fio2"]
    code_of = {c: F.lit(i).cast("byte") for i, c in enumerate(codes)}

    def narrow(df: DataFrame, t: str, code: Column, value: str) -> DataFrame:
        x = df.select(F.col(id_col), F.col(t).alias("_t"), code.alias("_code"), F.col(value).cast("double").alias("_v"))
        return x.where(F.col("_code").isNotNull() & F.col("_v").isNotNull())

    def by_category(cat: str, names) -> Column:
        return F.coalesce(*[F.when(F.col(cat) == c, code_of[c]) for c in names])

    def plausible(cat: str, value: str, ranges: dict) -> Column:
        return F.coalesce(*[F.when((F.col(cat) == c) & F.col(value).between(*ranges[c]), code_of[c]) for c in ranges])

    # respiratory support: impute device and FiO2, rank devices, worst per id
    r = clean_fio2(resp).withColumn("device_category", impute_device())
    r = r.select(id_col, "recorded_dttm", device_rank("device_category").cast("double").alias("device"), impute_fio2().alias("fio2"))
    v = vitals.where(((F.col("vital_category") == "spo2") & (F.col("vital_value") >= 60))
                     | ((F.col("vital_category") == "map") & (F.col("vital_value") >= 30)))
    rows = [narrow(v, "recorded_dttm", by_category("vital_category", ["spo2", "map"]), "vital_value"),
            narrow(labs, "lab_order_dttm", plausible("lab_category", "lab_value_numeric", {c: fixed.LAB_RANGES[c] for c in labs_of}), "lab_value_numeric"),
            narrow(gcs, "recorded_dttm", code_of["gcs"], "numerical_value"),
            narrow(meds, "admin_dttm", by_category("med_category", drugs), "med_dose_converted"),
            narrow(r.unpivot([id_col, "recorded_dttm"], ["device", "fio2"], "kind", "value"), "recorded_dttm",
                   by_category("kind", ["device", "fio2"]), "value")]
    long = rows[0]
    for other in rows[1:]:
        long = long.unionByName(other)
    inside = window_join(w, long, id_col=id_col, t="_t", lo=lo, hi=hi)

    def worst(agg, code: str) -> Column:
        return agg(F.when(F.col("_code") == code_of[code], F.col("_v")))

    # the worst over time of each time's worst is the worst of all
    worsts = inside.groupBy(id_col).agg(
        worst(F.min, "spo2").alias("spo2_min"), worst(F.min, "map").alias("map_min"),
        worst(F.min, "device").cast("int").alias("_rank"), worst(F.max, "fio2").alias("fio2_max"),
        *[worst(F.max, c).alias(f"{c}_max") for c in fixed.LABS_WORST_IS_MAX], *[worst(F.min, c).alias(f"{c}_min") for c in fixed.LABS_WORST_IS_MIN],
        worst(F.min, "gcs").alias("min_gcs_score"), *[worst(F.max, d).alias(d) for d in drugs])
    x = w.select(id_col).join(worsts, id_col, "left").withColumn("resp_support_max", rank_device("_rank")).drop("_rank")
    # imputed PaO2 rises with SpO2 up to its cut, so the lowest is that of the lowest SpO2
    x = x.withColumn("pao2_imputed_min", pao2_from_spo2("spo2_min"))
    x = x.withColumns({
        "p_f": F.try_divide(F.col("po2_arterial_min"), F.col("fio2_max")),
        "p_f_imputed": F.try_divide(F.col("pao2_imputed_min"), F.col("fio2_max")),
        "s_f": F.try_divide(F.col("spo2_min"), F.col("fio2_max")),
    })
    x = x.withColumns(sofa_components())
    x = x.withColumn("sofa_resp", F.greatest("sofa_resp_pf", "sofa_resp_pf_imp"))
    return x.withColumn("sofa_97_24hr", F.col("sofa_cv_97") + F.col("sofa_coag") + F.col("sofa_renal")
                        + F.col("sofa_liver") + F.col("sofa_resp") + F.col("sofa_cns"))


SOFA_PARTS = ["sofa_97_24hr", "sofa_cv_97", "sofa_coag", "sofa_renal", "sofa_liver", "sofa_resp", "sofa_cns"]


def organ_score_distribution(scores: DataFrame, *, id_col: str) -> DataFrame:
    """SET-3 + AGG-7: median and quartiles of each component over encounters."""
    long = scores.select(id_col, *[F.col(c).cast("double").alias(c) for c in SOFA_PARTS]).unpivot(
        [id_col], SOFA_PARTS, "sofa_category", "sofa_value")
    # a component has a few integer values, so the built-in's map of value to count is short
    return long.groupBy("sofa_category").agg(*[F.percentile("sofa_value", p).alias(name) for name, p in (
        ("overall_median", 0.5), ("overall_iqr_lower", 0.25), ("overall_iqr_upper", 0.75))])
