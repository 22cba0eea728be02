"""Independent SQL formulations (DuckDB dialect) of every catalogued query.

They follow the reference's *row-by-row* semantics (ranks, lags, running sums), not the
Spark plans, so a match checks the plan rewrites as well as the arithmetic.  The
analogue inputs are the CTEs below, mirroring plans/analogues.py.
"""

STAYS = """stays AS (
  SELECT CAST(user_id AS VARCHAR) AS hospitalization_id,
         CASE WHEN event_id % 50 = 0 THEN NULL
              WHEN event_type = 'purchase' THEN 'icu'
              WHEN event_type = 'signup' THEN 'procedural'
              ELSE event_type END AS location_category,
         ts AS in_dttm,
         LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS out_dttm,
         event_id
  FROM events)"""

ENC = """enc AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS hospitalization_id,
         CAST(c.c_custkey AS VARCHAR) AS patient_id,
         CASE WHEN c.c_custkey % 13 = 0 THEN NULL
              ELSE CAST(abs(floor(c.c_acctbal)) % 80 + 10 AS DOUBLE) END AS age_at_admission,
         CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE lo.o_orderpriority END AS discharge_category,
         a.admission_dttm
  FROM customer c
  LEFT JOIN (SELECT user_id, min(ts) AS admission_dttm FROM events GROUP BY user_id) a
         ON c.c_custkey = a.user_id
  LEFT JOIN (SELECT o_custkey, o_orderpriority FROM (
               SELECT o_custkey, o_orderpriority,
                      ROW_NUMBER() OVER (PARTITION BY o_custkey
                                         ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
               FROM orders) WHERE rn = 1) lo
         ON c.c_custkey = lo.o_custkey)"""

PATIENTS = """pat AS (
  SELECT CAST(c_custkey AS VARCHAR) AS patient_id,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'White'
                           WHEN 'BUILDING' THEN 'Black or African American'
                           WHEN 'FURNITURE' THEN 'Asian'
                           WHEN 'HOUSEHOLD' THEN 'Unknown'
                           WHEN 'MACHINERY' THEN 'Multiple' END AS race_category,
         CASE c_nationkey % 4 WHEN 0 THEN 'Hispanic' WHEN 1 THEN 'Non-Hispanic'
                              WHEN 2 THEN '*Unspecified' END AS ethnicity_category,
         CASE WHEN c_custkey % 11 = 0 THEN NULL
              WHEN c_nationkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS sex_category
  FROM customer)"""

# Reference semantics of the first block: rank by time, keep from the first ICU row,
# merge OR into ICU, change flags, running sum, collapse, keep block 1 lasting >= 24 h.
COHORT = """s AS (
  SELECT st.*, e.patient_id, e.age_at_admission, e.discharge_category, e.admission_dttm,
         CASE WHEN upper(st.location_category) = 'PROCEDURAL' THEN 'OR'
              ELSE upper(st.location_category) END AS st
  FROM stays st LEFT JOIN enc e USING (hospitalization_id)),
q AS (
  SELECT DISTINCT hospitalization_id FROM s
  WHERE st = 'ICU' AND in_dttm >= admission_dttm
    AND in_dttm <= admission_dttm + INTERVAL 48 HOUR
    AND admission_dttm >= TIMESTAMP '2024-01-01' AND admission_dttm < TIMESTAMP '2025-01-01'
    AND age_at_admission >= 18),
r AS (
  SELECT s.*, ROW_NUMBER() OVER (PARTITION BY hospitalization_id ORDER BY in_dttm, event_id) AS rk
  FROM s WHERE hospitalization_id IN (SELECT hospitalization_id FROM q)
    AND in_dttm <= admission_dttm + INTERVAL 72 HOUR),
m AS (
  SELECT *, MIN(CASE WHEN st = 'ICU' THEN rk END) OVER (PARTITION BY hospitalization_id) AS min_icu
  FROM r),
k AS (
  SELECT *, CASE WHEN st = 'OR' THEN 'ICU' ELSE st END AS st2 FROM m WHERE rk >= min_icu),
chg AS (
  SELECT *, CASE WHEN rk = min_icu THEN 1
                 WHEN LAG(st2) OVER (PARTITION BY hospitalization_id ORDER BY rk)
                      IS NOT DISTINCT FROM st2 THEN 0 ELSE 1 END AS c FROM k),
grp AS (
  SELECT *, SUM(c) OVER (PARTITION BY hospitalization_id ORDER BY rk
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM chg),
cohort AS (
  SELECT hospitalization_id, any_value(patient_id) AS patient_id,
         any_value(age_at_admission) AS age, any_value(discharge_category) AS dispo,
         min(in_dttm) AS min_in_dttm, max(out_dttm) AS max_out_dttm,
         min(in_dttm) + INTERVAL 24 HOUR AS after_24hr
  FROM grp WHERE g = 1 GROUP BY hospitalization_id
  HAVING max(out_dttm) >= min(in_dttm) + INTERVAL 24 HOUR)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["first_block"] = with_(STAYS, ENC, COHORT) + """
SELECT hospitalization_id, patient_id, age, dispo, min_in_dttm, max_out_dttm, after_24hr FROM cohort"""

SQL["state_blocks"] = with_(STAYS) + """,
k AS (SELECT *, CASE WHEN upper(location_category) IN ('PROCEDURAL', 'OR') THEN 'ICU'
                     ELSE upper(location_category) END AS st FROM stays),
chg AS (SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY hospitalization_id ORDER BY in_dttm, event_id) = 1
                        THEN 1
                        WHEN LAG(st) OVER (PARTITION BY hospitalization_id ORDER BY in_dttm, event_id)
                        IS NOT DISTINCT FROM st THEN 0 ELSE 1 END AS c FROM k),
grp AS (SELECT *, SUM(c) OVER (PARTITION BY hospitalization_id ORDER BY in_dttm, event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS block FROM chg)
SELECT hospitalization_id, CAST(block AS BIGINT) AS block, any_value(st) AS location_category,
       min(in_dttm) AS min_in_dttm, max(out_dttm) AS max_out_dttm, count(*) AS n_rows
FROM grp GROUP BY hospitalization_id, block"""

SQL["cohort_demographics"] = with_(STAYS, ENC, PATIENTS, COHORT) + """
SELECT c.hospitalization_id, c.patient_id, c.age, c.dispo, c.min_in_dttm, c.max_out_dttm,
       c.after_24hr, p.sex_category AS sex,
       CAST(lower(p.sex_category) = 'female' AS INTEGER) AS isfemale,
       CAST(regexp_matches(coalesce(c.dispo, 'Other'), '(?i)urgent|high') AS INTEGER) AS isdeathdispo,
       CASE p.race_category WHEN 'White' THEN 'White'
            WHEN 'Black or African American' THEN 'Black'
            WHEN 'Black or African-American' THEN 'Black'
            WHEN 'Asian' THEN 'Asian' ELSE 'Others' END AS race,
       CASE WHEN p.ethnicity_category IN ('Hispanic', 'Hispanic or Latino') THEN 'Hispanic or Latino'
            ELSE 'Not Hispanic or Latino' END AS ethnicity,
       round(epoch_us(c.max_out_dttm - c.min_in_dttm) / 3.6e9, 6) AS ICU_stay_hrs
FROM cohort c LEFT JOIN pat p USING (patient_id)
WHERE p.sex_category IS NOT NULL"""

OBS = """obs AS (
  SELECT CAST(user_id AS VARCHAR) AS hospitalization_id, ts AS recorded_dttm,
         event_type AS vital_category,
         CASE WHEN event_id % 23 = 0 THEN NULL ELSE value END AS vital_value,
         TRY_CAST(CASE WHEN event_id % 23 = 0 THEN NULL
                       WHEN event_id % 17 = 0 THEN '>' || CAST(value AS VARCHAR)
                       ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS v,
         event_id
  FROM events)"""

DOSES = """doses AS (
  SELECT CAST(user_id AS VARCHAR) AS hospitalization_id, ts AS admin_dttm,
         CASE event_id % 8 WHEN 0 THEN 'norepinephrine' WHEN 1 THEN 'epinephrine'
              WHEN 2 THEN 'phenylephrine' WHEN 3 THEN 'vasopressin' WHEN 4 THEN 'dopamine'
              WHEN 5 THEN 'angiotensin' WHEN 6 THEN 'dobutamine' ELSE 'milrinone' END AS med_category,
         CASE WHEN event_id % 29 = 0 THEN NULL ELSE value END AS med_dose,
         CASE event_id % 5 WHEN 0 THEN 'mcg/kg/min' WHEN 1 THEN 'MCG/MIN' WHEN 2 THEN 'mg/hr'
              WHEN 3 THEN 'units/min' ELSE 'ng/kg/min' END AS med_dose_unit,
         event_id
  FROM events WHERE event_type = 'purchase'),
weights AS (
  SELECT CAST(user_id AS VARCHAR) AS hospitalization_id, ts AS recorded_dttm, value AS weight_kg,
         event_id AS w_event_id
  FROM events WHERE event_type = 'view')"""

_CATS = ["view", "purchase", "signup", "click", "error", "temp_c"]

SQL["window_features_wide"] = with_(STAYS, ENC, COHORT, OBS) + """,
inside AS (
  SELECT o.* FROM obs o JOIN cohort c USING (hospitalization_id)
  WHERE o.recorded_dttm >= c.min_in_dttm AND o.recorded_dttm <= c.after_24hr),
piv AS (
  SELECT hospitalization_id, recorded_dttm,
""" + ",\n".join(f"    first(v ORDER BY event_id) FILTER (WHERE vital_category = '{c}') AS {c}"
                 for c in _CATS) + """
  FROM inside GROUP BY hospitalization_id, recorded_dttm)
SELECT c.hospitalization_id,
""" + ",\n".join(f"  min({c}) AS {c}_min, max({c}) AS {c}_max, round(avg({c}), 6) AS {c}_mean"
                 for c in _CATS) + """
FROM cohort c LEFT JOIN piv USING (hospitalization_id)
GROUP BY c.hospitalization_id"""

SQL["ratio_at_same_time"] = with_(OBS) + """,
piv AS (
  SELECT hospitalization_id, date_trunc('day', recorded_dttm) AS recorded_dttm,
         first(vital_value ORDER BY event_id) FILTER (WHERE vital_category = 'view') AS weight_kg,
         first(vital_value ORDER BY event_id) FILTER (WHERE vital_category = 'click') AS height_cm
  FROM obs WHERE vital_category IN ('view', 'click')
  GROUP BY 1, 2)
SELECT hospitalization_id, recorded_dttm, weight_kg, height_cm,
       round(CASE WHEN height_cm = 0 THEN NULL
                  ELSE weight_kg / ((height_cm / 100.0) * (height_cm / 100.0)) END, 6) AS bmi
FROM piv"""

SQL["range_filtered_worst"] = with_(OBS) + """,
ok AS (
  SELECT * FROM obs
  WHERE ((vital_category = 'view' AND vital_value BETWEEN 0 AND 400)
      OR (vital_category = 'error' AND vital_value BETWEEN 1 AND 450)
      OR (vital_category = 'click' AND vital_value BETWEEN 5 AND 500)
      OR (vital_category = 'purchase' AND vital_value >= 10))
    AND vital_value IS NOT NULL),
per_time AS (
  SELECT hospitalization_id, recorded_dttm, vital_category,
         CASE WHEN vital_category IN ('view', 'error') THEN max(vital_value)
              ELSE min(vital_value) END AS worst
  FROM ok GROUP BY 1, 2, 3)
SELECT hospitalization_id,
       max(worst) FILTER (WHERE vital_category = 'view') AS view_max,
       max(worst) FILTER (WHERE vital_category = 'error') AS error_max,
       min(worst) FILTER (WHERE vital_category = 'click') AS click_min,
       min(worst) FILTER (WHERE vital_category = 'purchase') AS purchase_min
FROM per_time GROUP BY hospitalization_id"""

SQL["asof_weight"] = with_(DOSES) + """
SELECT d.hospitalization_id, d.admin_dttm, d.med_category, d.med_dose, d.med_dose_unit, d.event_id,
       w.weight_kg, CAST(w.w_event_id AS VARCHAR) AS w_event_id, w.recorded_dttm
FROM doses d ASOF LEFT JOIN weights w
  ON d.hospitalization_id = w.hospitalization_id AND d.admin_dttm >= w.recorded_dttm"""

SQL["asof_weight_swapped"] = with_(DOSES) + """
SELECT w.hospitalization_id, w.recorded_dttm, w.weight_kg, w.w_event_id,
       d.med_category, d.med_dose, d.med_dose_unit, CAST(d.event_id AS VARCHAR) AS event_id, d.admin_dttm
FROM weights w ASOF LEFT JOIN doses d
  ON w.hospitalization_id = d.hospitalization_id AND w.recorded_dttm >= d.admin_dttm"""

SCORED = """sc AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS case_id,
         CAST(o.o_orderstatus = 'F' AS INTEGER) AS label,
         o.o_totalprice / 500000.0 AS score,
         CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE o.o_orderpriority END AS priority,
         c.c_mktsegment AS segment, r.r_name AS site, CAST(year(o.o_orderdate) AS INTEGER) AS year
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

LADDER = """lad0 AS (
  SELECT site, score, CAST(sum(label) AS BIGINT) AS pos, CAST(count(*) - sum(label) AS BIGINT) AS neg
  FROM sc GROUP BY site, score),
lad AS (
  SELECT site, score, pos, neg,
         CAST(sum(pos) OVER w AS BIGINT) AS cum_pos, CAST(sum(neg) OVER w AS BIGINT) AS cum_neg,
         CAST(row_number() OVER w AS BIGINT) AS rank,
         CAST(sum(pos) OVER (PARTITION BY site) AS BIGINT) AS P,
         CAST(sum(neg) OVER (PARTITION BY site) AS BIGINT) AS N
  FROM lad0
  WINDOW w AS (PARTITION BY site ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

# ROC points as roc_curve(drop_intermediate=True): keep the ends and every point where the
# second difference of the cumulative counts is non-zero; prepend (0, 0, inf).
ROC = """roc AS (
  SELECT site, cum_neg / N AS fpr, cum_pos / P AS tpr, score AS threshold, cum_pos, cum_neg, P, N
  FROM (SELECT *, LEAD(pos) OVER (PARTITION BY site ORDER BY score DESC) AS npos,
                  LEAD(neg) OVER (PARTITION BY site ORDER BY score DESC) AS nneg FROM lad)
  WHERE rank = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg
  UNION ALL
  SELECT DISTINCT site, 0.0, 0.0, 'inf'::DOUBLE, 0, 0, P, N FROM lad)"""

# AUC by the rank-sum (Mann-Whitney) formula with average ranks for ties.
AUC = """rk AS (
  SELECT site, label, rank() OVER (PARTITION BY site ORDER BY score)
         + (count(*) OVER (PARTITION BY site, score) - 1) / 2.0 AS r FROM sc),
auc AS (
  SELECT site, (sum(r) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2.0)
               / (sum(label) * (count(*) - sum(label)))::DOUBLE AS auc
  FROM rk GROUP BY site)"""

CONF = """conf AS (
  SELECT site,
         CAST(count(*) FILTER (WHERE label = 0 AND score < 0.208) AS BIGINT) AS tn,
         CAST(count(*) FILTER (WHERE label = 0 AND score >= 0.208) AS BIGINT) AS fp,
         CAST(count(*) FILTER (WHERE label = 1 AND score < 0.208) AS BIGINT) AS fn,
         CAST(count(*) FILTER (WHERE label = 1 AND score >= 0.208) AS BIGINT) AS tp,
         avg((score - label) * (score - label)) AS brier
  FROM sc GROUP BY site)"""


def _rates(tn="tn", fp="fp", fn="fn", tp="tp", zero=None):
    def r(a, b):
        z = "NULL" if zero is None else zero
        return f"CASE WHEN ({b}) = 0 THEN {z} ELSE {a}::DOUBLE / ({b}) END"
    return {
        "sensitivity": r(tp, f"{tp} + {fn}"),
        "specificity": r(tn, f"{tn} + {fp}"),
        "ppv": r(tp, f"{tp} + {fp}"),
        "npv": r(tn, f"{tn} + {fn}"),
        "recall": r(tp, f"{tp} + {fn}"),
        "accuracy": f"({tp} + {tn})::DOUBLE / ({tn} + {fp} + {fn} + {tp})",
    }


SQL["score_ladder"] = with_(SCORED, LADDER) + "SELECT * FROM lad"

SQL["roc_points"] = with_(SCORED, LADDER, ROC) + "SELECT site, fpr, tpr, threshold FROM roc"

SQL["pr_points"] = with_(SCORED, LADDER) + """
SELECT site, cum_pos::DOUBLE / (cum_pos + cum_neg) AS precision,
       CASE WHEN P = 0 THEN 1.0 ELSE cum_pos::DOUBLE / P END AS recall, score AS threshold FROM lad
UNION ALL SELECT DISTINCT site, 1.0, 0.0, 1.0 FROM lad"""

SQL["threshold_metrics_all"] = with_(SCORED, LADDER, ROC) + """
SELECT site, threshold, (cum_pos + (N - cum_neg))::DOUBLE / (P + N) AS accuracy,
       cum_pos::DOUBLE / P AS recall,
       CASE WHEN cum_pos + cum_neg = 0 THEN 0.0 ELSE cum_pos::DOUBLE / (cum_pos + cum_neg) END AS precision
FROM roc"""

SQL["metrics_at_threshold"] = with_(SCORED, CONF) + "SELECT site, 0.208::DOUBLE AS thr_value, tn, fp, fn, tp, " + \
    ", ".join(f"{v} AS {k}" for k, v in _rates().items()) + " FROM conf"

SQL["auc_brier"] = with_(SCORED, CONF, AUC) + """,
m AS (SELECT conf.*, auc.auc FROM conf JOIN auc USING (site))
SELECT site, 'Accuracy' AS metric, round((tp + tn)::DOUBLE / (tn + fp + fn + tp), 6) AS value FROM m
UNION ALL SELECT site, 'Recall', round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fn) END, 6) FROM m
UNION ALL SELECT site, 'Precision', round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp) END, 6) FROM m
UNION ALL SELECT site, 'ROC AUC', round(auc, 6) FROM m
UNION ALL SELECT site, 'Brier Score Loss', round(brier, 6) FROM m"""

_QLIST = "[" + ", ".join(f"{k / 100!r}::DOUBLE" for k in range(100, 0, -1)) + "]"

SWEEP = """qs AS (
  SELECT site, unnest(quantile_cont(score, """ + _QLIST + """)) AS thr_value,
         unnest(""" + _QLIST + """) AS q
  FROM sc GROUP BY site),
sw AS (
  SELECT q.site, q.q, q.thr_value,
         CAST(count(*) FILTER (WHERE s.label = 0 AND s.score < q.thr_value) AS BIGINT) AS tn,
         CAST(count(*) FILTER (WHERE s.label = 0 AND s.score >= q.thr_value) AS BIGINT) AS fp,
         CAST(count(*) FILTER (WHERE s.label = 1 AND s.score < q.thr_value) AS BIGINT) AS fn,
         CAST(count(*) FILTER (WHERE s.label = 1 AND s.score >= q.thr_value) AS BIGINT) AS tp
  FROM qs q JOIN sc s ON s.site = q.site
  GROUP BY q.site, q.q, q.thr_value),
nb AS (
  SELECT *, CASE WHEN thr_value = 1 THEN NULL
                 ELSE (tp - fp * (thr_value / (1 - thr_value))) / (tn + fp + fn + tp) END AS net_benefit
  FROM sw)"""

SQL["topn_sweep"] = with_(SCORED, SWEEP) + """
SELECT site, q, 'Top ' || CAST(round((1.0 - q) * 100, 0) AS VARCHAR) || '%' AS n_percentile,
       round(thr_value, 6) AS thr_value, tn, fp, fn, tp, """ + ", ".join(
    f"round({v}, 6) AS {k}" for k, v in _rates().items()) + " FROM sw"

_EDGES = " + ".join(f"CASE WHEN {k}.0 * ((mx - mn) / 10.0) + mn < score THEN 1 ELSE 0 END"
                    for k in range(1, 10))

SQL["calibration_equal_width"] = with_(SCORED) + """,
mm AS (SELECT site, min(score) AS mn, max(score) AS mx FROM sc GROUP BY site),
b AS (SELECT sc.*, CAST(""" + _EDGES + """ AS INTEGER) AS bin FROM sc JOIN mm USING (site)),
g AS (SELECT site, bin, avg(score) AS predicted_prob, avg(label::DOUBLE) AS actual_prob, count(*) AS n
      FROM b GROUP BY site, bin)
SELECT site, bin, n, round(predicted_prob, 6) AS predicted_prob, round(actual_prob, 6) AS actual_prob,
       round(sqrt(actual_prob * (1 - actual_prob) / n), 6) AS se,
       round(actual_prob - 1.96 * sqrt(actual_prob * (1 - actual_prob) / n), 6) AS lower_ci,
       round(actual_prob + 1.96 * sqrt(actual_prob * (1 - actual_prob) / n), 6) AS upper_ci
FROM g"""

_FIXED = [round(0.05 * k, 2) for k in range(1, 20)]
SQL["calibration_fixed_edges"] = with_(SCORED) + """,
b AS (SELECT sc.*, """ + " + ".join(f"CASE WHEN {e!r} <= score THEN 1 ELSE 0 END" for e in _FIXED) + """ AS idx
      FROM sc)
SELECT site, CASE """ + " ".join(f"WHEN idx = {i} THEN {e!r}" for i, e in enumerate(_FIXED)) + """
       ELSE 19.0 END AS prob_bin_val,
       count(*) AS n, round(avg(label::DOUBLE), 6) AS actual_prob, round(avg(score), 6) AS predicted_prob
FROM b GROUP BY 1, 2"""

SQL["fairness"] = with_(SCORED) + """,
tot AS (SELECT site, count(*) AS total_count FROM sc GROUP BY site),
long AS (
  SELECT site, label, score, 'priority' AS subgroup, priority AS group_value FROM sc WHERE priority IS NOT NULL
  UNION ALL
  SELECT site, label, score, 'segment', segment FROM sc WHERE segment IS NOT NULL),
rk AS (
  SELECT *, rank() OVER (PARTITION BY site, subgroup, group_value ORDER BY score)
            + (count(*) OVER (PARTITION BY site, subgroup, group_value, score) - 1) / 2.0 AS r FROM long),
g AS (
  SELECT site, subgroup, group_value,
         CAST(count(*) FILTER (WHERE label = 0 AND score <= 0.208) AS BIGINT) AS tn,
         CAST(count(*) FILTER (WHERE label = 1 AND score > 0.208) AS BIGINT) AS tp,
         CAST(count(*) FILTER (WHERE label = 0 AND score > 0.208) AS BIGINT) AS fp,
         CAST(count(*) FILTER (WHERE label = 1 AND score <= 0.208) AS BIGINT) AS fn,
         (sum(r) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2.0)
           / nullif(sum(label) * (count(*) - sum(label)), 0)::DOUBLE AS auc,
         avg((score - label) * (score - label)) AS brier, count(*) AS group_count
  FROM rk GROUP BY site, subgroup, group_value)
SELECT g.site, subgroup, group_value, tn, tp, fp, fn, group_count, total_count,
       round(CASE WHEN two THEN auc END, 6) AS auc, """ + ", ".join(
    f"round(CASE WHEN two THEN {v} END, 6) AS {k}" for k, v in _rates(zero="0.0").items()
    if k in ("ppv", "sensitivity", "specificity", "npv", "recall", "accuracy")) + """,
       round(CASE WHEN two THEN brier END, 6) AS brier_score,
       round(group_count / total_count, 6) AS proportion
FROM (SELECT *, (tp + fn > 0 AND tn + fp > 0) AS two FROM g) g JOIN tot USING (site)"""

SQL["net_benefit"] = with_(SCORED, SWEEP) + """
SELECT site, q, round(thr_value, 6) AS thr_value, round(net_benefit, 6) AS net_benefit FROM nb"""

SQL["nearest_threshold"] = with_(SCORED, SWEEP) + """
SELECT site, q, round(thr_value, 6) AS thr_value, round(net_benefit, 6) AS net_benefit FROM (
  SELECT *, row_number() OVER (PARTITION BY site ORDER BY abs(thr_value - 0.208), thr_value DESC, q DESC) AS rn
  FROM nb)
WHERE rn = 1"""

SQL["calibration_slope"] = with_(SCORED) + """,
mm AS (SELECT site, min(score) AS mn, max(score) AS mx FROM sc GROUP BY site),
b AS (SELECT sc.*, CAST(""" + _EDGES + """ AS INTEGER) AS bin FROM sc JOIN mm USING (site)),
g AS (SELECT site, bin, avg(score) AS predicted_prob, avg(label::DOUBLE) AS actual_prob FROM b GROUP BY 1, 2)
SELECT site, round(regr_slope(actual_prob, predicted_prob), 6) AS slope,
       round(regr_intercept(actual_prob, predicted_prob), 6) AS intercept
FROM g GROUP BY site"""

SQL["site_table"] = with_(SCORED, CONF, AUC) + """
SELECT site, round(auc, 6) AS auc, round(brier, 6) AS brier,
       CAST(row_number() OVER (ORDER BY auc DESC, site) AS INTEGER) AS auc_rank,
       CAST(row_number() OVER (ORDER BY brier ASC, site) AS INTEGER) AS brier_rank
FROM conf JOIN auc USING (site)"""

# fixed values: conversion factors, drugs and modes, written out here so that a wrong one in the engine shows
FACTORS = """ft(drug, unit, factor, per_weight) AS (VALUES
  ('norepinephrine', 'mcg/kg/min', 1::DOUBLE, FALSE),
  ('norepinephrine', 'mcg/kg/hr', 1::DOUBLE / 60, FALSE),
  ('norepinephrine', 'mg/kg/hr', 1000::DOUBLE / 60, FALSE),
  ('norepinephrine', 'mcg/min', 1::DOUBLE, TRUE),
  ('norepinephrine', 'mg/hr', 1000::DOUBLE / 60, TRUE),
  ('epinephrine', 'mcg/kg/min', 1::DOUBLE, FALSE),
  ('epinephrine', 'mcg/kg/hr', 1::DOUBLE / 60, FALSE),
  ('epinephrine', 'mg/kg/hr', 1000::DOUBLE / 60, FALSE),
  ('epinephrine', 'mcg/min', 1::DOUBLE, TRUE),
  ('epinephrine', 'mg/hr', 1000::DOUBLE / 60, TRUE),
  ('phenylephrine', 'mcg/kg/min', 1::DOUBLE, FALSE),
  ('phenylephrine', 'mcg/kg/hr', 1::DOUBLE / 60, FALSE),
  ('phenylephrine', 'mg/kg/hr', 1000::DOUBLE / 60, FALSE),
  ('phenylephrine', 'mcg/min', 1::DOUBLE, TRUE),
  ('phenylephrine', 'mg/hr', 1000::DOUBLE / 60, TRUE),
  ('dopamine', 'mcg/kg/min', 1::DOUBLE, FALSE),
  ('dopamine', 'mcg/kg/hr', 1::DOUBLE / 60, FALSE),
  ('dopamine', 'mg/kg/hr', 1000::DOUBLE / 60, FALSE),
  ('dopamine', 'mcg/min', 1::DOUBLE, TRUE),
  ('dopamine', 'mg/hr', 1000::DOUBLE / 60, TRUE),
  ('milrinone', 'mcg/kg/min', 1::DOUBLE, FALSE),
  ('milrinone', 'mcg/kg/hr', 1::DOUBLE / 60, FALSE),
  ('milrinone', 'mg/kg/hr', 1000::DOUBLE / 60, FALSE),
  ('milrinone', 'mcg/min', 1::DOUBLE, TRUE),
  ('milrinone', 'mg/hr', 1000::DOUBLE / 60, TRUE),
  ('dobutamine', 'mcg/kg/min', 1::DOUBLE, FALSE),
  ('dobutamine', 'mcg/kg/hr', 1::DOUBLE / 60, FALSE),
  ('dobutamine', 'mg/kg/hr', 1000::DOUBLE / 60, FALSE),
  ('dobutamine', 'mcg/min', 1::DOUBLE, TRUE),
  ('dobutamine', 'mg/hr', 1000::DOUBLE / 60, TRUE),
  ('angiotensin', 'ng/kg/min', 1::DOUBLE / 1000, FALSE),
  ('angiotensin', 'ng/kg/hr', 1::DOUBLE / 1000 / 60, FALSE),
  ('vasopressin', 'units/min', 1::DOUBLE, FALSE),
  ('vasopressin', 'units/hr', 1::DOUBLE / 60, FALSE),
  ('vasopressin', 'milliunits/min', 1::DOUBLE / 1000, FALSE),
  ('vasopressin', 'milliunits/hr', 1::DOUBLE / 1000 / 60, FALSE))"""
_MEDS = ["norepinephrine", "epinephrine", "phenylephrine", "vasopressin", "dopamine", "angiotensin", "dobutamine",
         "milrinone"]
_MODES = ["Assist Control-Volume Control", "Pressure Control", "Pressure-Regulated Volume Control", "SIMV",
          "Pressure Support/CPAP", "Volume Support", "Other"]

CONV = """aj AS (
  SELECT d.*, w.weight_kg FROM doses d ASOF LEFT JOIN weights w
    ON d.hospitalization_id = w.hospitalization_id AND d.admin_dttm >= w.recorded_dttm),
conv AS (
  SELECT a.*, round(a.med_dose * CASE WHEN ft.per_weight
                                      THEN CASE WHEN a.weight_kg = 0 THEN NULL ELSE ft.factor / a.weight_kg END
                                      ELSE ft.factor END, 3) AS med_dose_converted
  FROM aj a LEFT JOIN ft ON a.med_category = ft.drug AND lower(a.med_dose_unit) = ft.unit
  WHERE a.med_dose IS NOT NULL)"""

SQL["dose_converted"] = with_(DOSES, FACTORS, CONV) + """
SELECT hospitalization_id, admin_dttm, event_id, med_category, med_dose, med_dose_unit, weight_kg,
       med_dose_converted FROM conv"""

SQL["dose_summary"] = with_(DOSES, FACTORS, CONV) + """,
per AS (SELECT hospitalization_id, med_category, quantile_cont(med_dose_converted, 0.5) AS median
        FROM conv GROUP BY 1, 2),
ov AS (SELECT med_category,
              quantile_cont(median, 0.5) FILTER (WHERE median <> 0) AS overall_median_dose,
              quantile_cont(median, 0.25) FILTER (WHERE median <> 0) AS overall_iqr_lower,
              quantile_cont(median, 0.75) FILTER (WHERE median <> 0) AS overall_iqr_upper,
              count(*) AS n_encounters
       FROM per GROUP BY 1),
tot AS (SELECT count(DISTINCT user_id) AS n FROM events),
req(med_category) AS (VALUES """ + ", ".join(f"('{m}')" for m in _MEDS) + """)
SELECT req.med_category, CAST(ov.n_encounters AS DOUBLE) AS n_encounters, round(ov.overall_median_dose, 6) AS overall_median_dose,
       round(ov.overall_iqr_lower, 6) AS overall_iqr_lower, round(ov.overall_iqr_upper, 6) AS overall_iqr_upper,
       round(100.0 * ov.n_encounters / tot.n, 6) AS pct_encounters
FROM req LEFT JOIN ov USING (med_category) CROSS JOIN tot"""

SETTINGS = """sett AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS hospitalization_id, l_shipdate AS recorded_dttm, l_linenumber,
         CASE l_returnflag WHEN 'R' THEN 'IMV' WHEN 'A' THEN 'NIPPV' END AS device_category,
         CASE WHEN l_linenumber = 1 THEN '' WHEN l_linenumber = 7 THEN 'Unlisted Mode'
              WHEN l_linestatus = 'O' THEN 'Pressure Control' ELSE 'simv' END AS mode_category,
         l_discount * 10 + 0.0 AS fio2_set, l_quantity AS peep_set,
         CASE WHEN l_linenumber % 3 = 0 THEN l_tax * 1000 END AS tidal_volume_set,
         CASE WHEN l_linenumber % 2 = 0 THEN l_quantity / 2 END AS lpm_set
  FROM lineitem),
win AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS hospitalization_id, o_orderdate AS min_in_dttm,
         o_orderdate + INTERVAL 180 DAY AS after_24hr FROM orders),
vent AS (SELECT DISTINCT hospitalization_id FROM sett WHERE device_category IN ('IMV', 'Vent'))"""

SQL["settings_summary"] = with_(SETTINGS) + """,
r0 AS (SELECT * FROM sett WHERE hospitalization_id IN (SELECT hospitalization_id FROM vent)),
m AS (SELECT avg(fio2_set) AS mu FROM r0),
r1 AS (SELECT r0.*, CASE WHEN m.mu > 1 THEN fio2_set / 100 ELSE fio2_set END AS f FROM r0, m),
r AS (SELECT hospitalization_id, recorded_dttm,
             CASE WHEN peep_set >= 0 AND peep_set <= 30 THEN peep_set END AS peep,
             CASE WHEN f >= 0.21 AND f <= 1 THEN f END AS fio2 FROM r1),
ins AS (SELECT r.* FROM r JOIN win USING (hospitalization_id)
        WHERE recorded_dttm >= min_in_dttm AND recorded_dttm <= after_24hr)
SELECT round(quantile_cont(peep, 0.5), 6) AS median_peep, round(quantile_cont(peep, 0.25), 6) AS iqr_lower_peep,
       round(quantile_cont(peep, 0.75), 6) AS iqr_upper_peep,
       round(quantile_cont(fio2, 0.5), 6) AS median_fio2, round(quantile_cont(fio2, 0.25), 6) AS iqr_lower_fio2,
       round(quantile_cont(fio2, 0.75), 6) AS iqr_upper_fio2
FROM ins"""

SQL["initial_mode_table"] = with_(SETTINGS) + """,
req(mode_category, ord) AS (VALUES """ + ", ".join(f"('{m}', {i})" for i, m in enumerate(_MODES)) + """),
r AS (SELECT * FROM sett WHERE hospitalization_id IN (SELECT hospitalization_id FROM vent)
        AND nullif(trim(mode_category), '') IS NOT NULL),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hospitalization_id
                                                  ORDER BY recorded_dttm, l_linenumber) AS rn FROM r) WHERE rn = 1),
c AS (SELECT req.mode_category, count(*) AS n FROM f JOIN req ON lower(trim(f.mode_category)) = lower(req.mode_category)
      GROUP BY 1),
dens(denominator, d) AS (SELECT 'ventilated', (SELECT count(*) FROM vent)
                         UNION ALL SELECT 'all', (SELECT count(DISTINCT o_orderkey) FROM orders)),
body AS (SELECT dens.denominator, req.mode_category, CAST(c.n AS BIGINT) AS n_encounters,
                100.0 * c.n / dens.d AS pct_encounters, dens.d
         FROM dens CROSS JOIN req LEFT JOIN c USING (mode_category)),
nomode AS (SELECT denominator, 'No mode documented' AS mode_category,
                  CAST(any_value(d) - coalesce(sum(n_encounters), 0) AS BIGINT) AS n_encounters,
                  100.0 * (any_value(d) - coalesce(sum(n_encounters), 0)) / any_value(d) AS pct_encounters
           FROM body GROUP BY denominator),
allrows AS (SELECT denominator, mode_category, n_encounters, pct_encounters FROM body
            UNION ALL SELECT * FROM nomode)
SELECT denominator, mode_category, CAST(n_encounters AS DOUBLE) AS n_encounters,
       round(pct_encounters, 6) AS pct_encounters FROM allrows
UNION ALL
SELECT denominator, 'Total', CAST(sum(n_encounters) AS DOUBLE), round(sum(pct_encounters), 6) FROM allrows
GROUP BY denominator"""

SOFA = """sw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS hospitalization_id, l_shipdate AS recorded_dttm, l_linenumber AS ln,
         CASE WHEN l_linenumber <> 2 THEN 55.0 + l_quantity * 0.9 END AS spo2,
         CASE WHEN l_linenumber <> 3 THEN l_extendedprice / 1000.0 END AS map,
         l_tax * 100.0 AS creatinine, l_discount * 150.0 + 0.0 AS bilirubin_total,
         l_extendedprice / 100.0 AS po2_arterial,
         CASE WHEN l_linenumber <> 6 THEN l_quantity * 4.0 END AS platelet_count,
         CASE WHEN l_linenumber <> 4 THEN CAST(3 + l_linenumber * 2 AS DOUBLE) END AS gcs_total,
         CASE WHEN l_linenumber IN (1, 4) THEN l_tax * 3.0 END AS norepinephrine,
         CASE WHEN l_linenumber = 2 THEN l_quantity / 3.0 END AS dopamine,
         CASE WHEN l_linenumber = 3 THEN l_discount * 2.0 + 0.0 END AS epinephrine,
         CASE WHEN l_linenumber = 5 THEN l_discount + 0.0 END AS dobutamine
  FROM lineitem),
swin AS (SELECT sw.*, win.min_in_dttm, win.after_24hr FROM sw JOIN win USING (hospitalization_id)
         WHERE recorded_dttm >= min_in_dttm AND recorded_dttm <= after_24hr),
vt AS (
  SELECT hospitalization_id, recorded_dttm,
         min(CASE WHEN spo2 >= 60 THEN spo2 END) AS spo2, min(CASE WHEN map >= 30 THEN map END) AS map
  FROM swin GROUP BY 1, 2),
vit AS (
  SELECT hospitalization_id,
         min(CASE WHEN spo2 < 97 THEN
               cbrt(sqrt(125000.0 + (11700.0 / (1.0 / (spo2 / 100.0) - 1.0)) ^ 2) + 11700.0 / (1.0 / (spo2 / 100.0) - 1.0))
             - cbrt(sqrt(125000.0 + (11700.0 / (1.0 / (spo2 / 100.0) - 1.0)) ^ 2) - 11700.0 / (1.0 / (spo2 / 100.0) - 1.0))
             END) AS pao2_imputed_min,
         min(spo2) AS spo2_min, min(map) AS map_min
  FROM vt GROUP BY 1),
rs0 AS (
  SELECT s.*, CASE WHEN fio2_set >= 0.21 AND fio2_set <= 1 THEN fio2_set END AS f
  FROM sett s JOIN win USING (hospitalization_id)
  WHERE recorded_dttm >= min_in_dttm AND recorded_dttm <= after_24hr),
rs1 AS (
  SELECT *, CASE
      WHEN device_category = 'Nasal Cannula' AND f IS NULL AND lpm_set > 20 THEN 'High Flow NC'
      WHEN device_category IS NOT NULL THEN device_category
      WHEN lower(mode_category) IN ('simv', 'pressure-regulated volume control', 'assist control-volume control') THEN 'Vent'
      WHEN f = 0.21 AND lpm_set IS NULL AND peep_set IS NULL AND tidal_volume_set IS NULL THEN 'Room Air'
      WHEN f IS NULL AND lpm_set = 0 AND peep_set IS NULL AND tidal_volume_set IS NULL THEN 'Room Air'
      WHEN f IS NULL AND lpm_set <= 20 AND lpm_set > 0 AND peep_set IS NULL AND tidal_volume_set IS NULL THEN 'Nasal Cannula'
      WHEN f IS NULL AND lpm_set > 20 AND peep_set IS NULL AND tidal_volume_set IS NULL THEN 'High Flow NC'
    END AS dev FROM rs0),
rs2 AS (
  SELECT hospitalization_id,
         CASE WHEN f IS NOT NULL THEN f WHEN dev = 'Room Air' THEN 0.21
              WHEN dev = 'Nasal Cannula' THEN 0.24 + 0.04 * lpm_set END AS fio2_combined,
         CASE WHEN dev IN ('Vent', 'IMV') THEN 1 WHEN dev = 'NIPPV' THEN 2 WHEN dev = 'CPAP' THEN 3
              WHEN dev = 'High Flow NC' THEN 4 WHEN dev = 'Face Mask' THEN 5 WHEN dev = 'Trach Collar' THEN 6
              WHEN dev = 'Nasal Cannula' THEN 7 WHEN dev = 'Other' THEN 8 WHEN dev = 'Room Air' THEN 9 END AS rk
  FROM rs1),
rs AS (
  SELECT hospitalization_id, max(fio2_combined) AS fio2_max,
         CASE min(rk) WHEN 1 THEN 'Vent' WHEN 2 THEN 'NIPPV' WHEN 3 THEN 'CPAP' WHEN 4 THEN 'High Flow NC'
              WHEN 5 THEN 'Face Mask' WHEN 6 THEN 'Trach Collar' WHEN 7 THEN 'Nasal Cannula' WHEN 8 THEN 'Other'
              WHEN 9 THEN 'Room Air' END AS resp_support_max
  FROM rs2 GROUP BY 1),
lb AS (
  SELECT hospitalization_id,
         max(CASE WHEN creatinine BETWEEN 0 AND 20 THEN creatinine END) AS creatinine_max,
         max(CASE WHEN bilirubin_total BETWEEN 0 AND 80 THEN bilirubin_total END) AS bilirubin_total_max,
         min(CASE WHEN po2_arterial BETWEEN 30 AND 700 THEN po2_arterial END) AS po2_arterial_min,
         min(CASE WHEN platelet_count BETWEEN 0 AND 2000 THEN platelet_count END) AS platelet_count_min,
         min(gcs_total) AS min_gcs_score,
         max(norepinephrine) AS norepinephrine, max(dopamine) AS dopamine, max(epinephrine) AS epinephrine,
         max(dobutamine) AS dobutamine
  FROM swin GROUP BY 1),
x AS (
  SELECT win.hospitalization_id, rs.fio2_max, rs.resp_support_max, vit.*, lb.*
  FROM win LEFT JOIN rs USING (hospitalization_id) LEFT JOIN vit USING (hospitalization_id)
           LEFT JOIN lb USING (hospitalization_id)),
y AS (
  SELECT x.*, CASE WHEN fio2_max = 0 THEN NULL ELSE po2_arterial_min / fio2_max END AS p_f,
         CASE WHEN fio2_max = 0 THEN NULL ELSE pao2_imputed_min / fio2_max END AS p_f_imputed,
         CASE WHEN fio2_max = 0 THEN NULL ELSE spo2_min / fio2_max END AS s_f
  FROM x),
z AS (
  SELECT y.hospitalization_id AS hid, y.*,
    CASE WHEN dopamine > 15 OR epinephrine > 0.1 OR norepinephrine > 0.1 THEN 4
         WHEN dopamine > 5 OR (epinephrine <= 0.1 AND epinephrine > 0) OR (norepinephrine <= 0.1 AND norepinephrine > 0) THEN 3
         WHEN (dopamine <= 5 AND dopamine > 0) OR dobutamine > 0 THEN 2
         WHEN map_min < 70 THEN 1 ELSE 0 END AS sofa_cv_97,
    CASE WHEN platelet_count_min < 20 THEN 4 WHEN platelet_count_min < 50 THEN 3
         WHEN platelet_count_min < 100 THEN 2 WHEN platelet_count_min < 150 THEN 1 ELSE 0 END AS sofa_coag,
    CASE WHEN bilirubin_total_max >= 12.0 THEN 4 WHEN bilirubin_total_max >= 6.0 THEN 3
         WHEN bilirubin_total_max >= 2.0 THEN 2 WHEN bilirubin_total_max >= 1.2 THEN 1 ELSE 0 END AS sofa_liver,
    CASE WHEN creatinine_max >= 5.0 THEN 4 WHEN creatinine_max >= 3.5 AND creatinine_max < 5.0 THEN 3
         WHEN creatinine_max >= 2.0 AND creatinine_max < 3.5 THEN 2
         WHEN creatinine_max >= 1.2 AND creatinine_max < 2.0 THEN 1 ELSE 0 END AS sofa_renal,
    CASE WHEN p_f < 100 AND resp_support_max IN ('NIPPV', 'CPAP', 'Vent') THEN 4
         WHEN p_f < 200 AND resp_support_max IN ('NIPPV', 'CPAP', 'Vent') THEN 3
         WHEN p_f < 300 THEN 2 WHEN p_f < 400 THEN 1 ELSE 0 END AS sofa_resp_pf,
    CASE WHEN p_f_imputed < 100 AND resp_support_max IN ('NIPPV', 'CPAP', 'Vent') THEN 4
         WHEN p_f_imputed < 200 AND resp_support_max IN ('NIPPV', 'CPAP', 'Vent') THEN 3
         WHEN p_f_imputed < 300 THEN 2 WHEN p_f_imputed < 400 THEN 1 ELSE 0 END AS sofa_resp_pf_imp,
    CASE WHEN min_gcs_score < 6 THEN 4 WHEN min_gcs_score >= 6 AND min_gcs_score <= 9 THEN 3
         WHEN min_gcs_score >= 10 AND min_gcs_score <= 12 THEN 2
         WHEN min_gcs_score >= 13 AND min_gcs_score <= 14 THEN 1 ELSE 0 END AS sofa_cns
  FROM y),
sofa AS (
  SELECT *, greatest(sofa_resp_pf, sofa_resp_pf_imp) AS sofa_resp,
         sofa_cv_97 + sofa_coag + sofa_renal + sofa_liver + greatest(sofa_resp_pf, sofa_resp_pf_imp) + sofa_cns
           AS sofa_97_24hr
  FROM z)"""

SQL["organ_score"] = with_(SETTINGS, SOFA) + """
SELECT hid AS hospitalization_id, round(p_f, 6) AS p_f, round(p_f_imputed, 6) AS p_f_imputed, round(s_f, 6) AS s_f,
       resp_support_max, sofa_cv_97, sofa_coag, sofa_liver, sofa_renal, sofa_resp_pf, sofa_resp_pf_imp, sofa_resp,
       sofa_cns, sofa_97_24hr
FROM sofa"""

SQL["organ_score_distribution"] = with_(SETTINGS, SOFA) + """,
long AS (UNPIVOT (SELECT hid, sofa_97_24hr, sofa_cv_97, sofa_coag, sofa_renal, sofa_liver, sofa_resp, sofa_cns FROM sofa)
         ON sofa_97_24hr, sofa_cv_97, sofa_coag, sofa_renal, sofa_liver, sofa_resp, sofa_cns
         INTO NAME sofa_category VALUE sofa_value)
SELECT sofa_category, round(quantile_cont(CAST(sofa_value AS DOUBLE), 0.5), 6) AS overall_median,
       round(quantile_cont(CAST(sofa_value AS DOUBLE), 0.25), 6) AS overall_iqr_lower,
       round(quantile_cont(CAST(sofa_value AS DOUBLE), 0.75), 6) AS overall_iqr_upper
FROM long GROUP BY 1"""

_LF = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

SQL["describe_features"] = """
WITH long AS (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
              ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE v),
s AS (SELECT feature, CAST(count(v) AS DOUBLE) AS "count", avg(v) AS "mean", stddev_samp(v) AS "std",
             min(v) AS "min", quantile_cont(v, 0.25) AS "25%", quantile_cont(v, 0.5) AS "50%",
             quantile_cont(v, 0.75) AS "75%", max(v) AS "max" FROM long GROUP BY feature),
l2 AS (UNPIVOT s ON "count", "mean", "std", "min", "25%", "50%", "75%", "max" INTO NAME statistic VALUE value)
SELECT statistic, """ + ", ".join(f"round(max(value) FILTER (WHERE feature = '{c}'), 6) AS {c}" for c in _LF) + """
FROM l2 GROUP BY statistic"""

SQL["missingness"] = with_(SETTINGS) + """,
t AS (SELECT count(*) AS n, """ + ", ".join(f"CAST(count(*) - count({c}) AS BIGINT) AS {c}" for c in
      ["device_category", "mode_category", "fio2_set", "peep_set", "tidal_volume_set", "lpm_set"]) + """ FROM sett)
SELECT "column", na_count, n AS total_rows, round(na_count * 100.0 / n, 6) AS nan_percentage
FROM (UNPIVOT t ON device_category, mode_category, fio2_set, peep_set, tidal_volume_set, lpm_set
      INTO NAME "column" VALUE na_count)"""

SQL["histogram30"] = """
WITH long AS (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
              ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE v),
mm AS (SELECT feature, min(v) AS mn, max(v) AS mx FROM long GROUP BY feature),
b AS (SELECT long.feature, mn, mx, CAST(""" + " + ".join(
    f"CASE WHEN {k}.0 * ((mx - mn) / 30.0) + mn <= v THEN 1 ELSE 0 END" for k in range(1, 30)) + """ AS INTEGER) AS bin
      FROM long JOIN mm USING (feature) WHERE v IS NOT NULL)
SELECT feature, bin, count(*) AS n, round(any_value(bin * ((mx - mn) / 30.0) + mn), 6) AS bin_lower
FROM b GROUP BY feature, bin"""

SQL["table1"] = with_(ENC, PATIENTS) + """,
ppl AS (
  SELECT e.hospitalization_id, e.age_at_admission, p.sex_category AS sex,
         CASE p.race_category WHEN 'White' THEN 'White' WHEN 'Black or African American' THEN 'Black'
              WHEN 'Black or African-American' THEN 'Black' WHEN 'Asian' THEN 'Asian' ELSE 'Others' END AS race,
         CASE WHEN p.ethnicity_category IN ('Hispanic', 'Hispanic or Latino') THEN 'Hispanic or Latino'
              ELSE 'Not Hispanic or Latino' END AS ethnicity,
         CAST(CAST(regexp_matches(coalesce(e.discharge_category, 'Other'), '(?i)urgent|high') AS INTEGER) AS VARCHAR)
           AS Mortality
  FROM enc e LEFT JOIN pat p USING (patient_id)),
cont AS (
  SELECT 'age_at_admission' AS variable, '' AS level, statistic, value FROM (
    UNPIVOT (SELECT CAST(count(age_at_admission) AS DOUBLE) AS n, avg(age_at_admission) AS mean,
                    stddev_samp(age_at_admission) AS sd, quantile_cont(age_at_admission, 0.5) AS median,
                    min(age_at_admission) AS min, max(age_at_admission) AS max,
                    CAST(count(*) - count(age_at_admission) AS DOUBLE) AS missing FROM ppl)
    ON n, mean, sd, median, min, max, missing INTO NAME statistic VALUE value)),
cat AS (
  SELECT 'sex' AS variable, sex AS level FROM ppl UNION ALL SELECT 'race', race FROM ppl
  UNION ALL SELECT 'ethnicity', ethnicity FROM ppl UNION ALL SELECT 'Mortality', Mortality FROM ppl),
cnt AS (SELECT variable, level, CAST(count(*) AS DOUBLE) AS n FROM cat WHERE level IS NOT NULL GROUP BY 1, 2),
lv AS (SELECT variable, level, n, n * 100.0 / sum(n) OVER (PARTITION BY variable) AS pct FROM cnt)
SELECT variable, level, statistic, round(value, 6) AS value FROM cont
UNION ALL SELECT variable, level, 'n', n FROM lv
UNION ALL SELECT variable, level, 'pct', round(pct, 6) FROM lv
UNION ALL SELECT variable, '', 'missing', CAST(count(*) - count(level) AS DOUBLE) FROM cat GROUP BY variable
UNION ALL SELECT 'N', '', 'n', CAST(count(*) AS DOUBLE) FROM ppl"""

SQL["split_tag"] = with_(SCORED) + """
SELECT case_id, year, CASE WHEN year IN (1998, 1999) THEN 'test' ELSE 'train' END AS Data_Type FROM sc"""

SQL["lookup_map"] = with_(SCORED) + """
SELECT case_id, site, CASE site WHEN 'AFRICA' THEN 'Africa Region' WHEN 'AMERICA' THEN 'Americas Region'
                                WHEN 'ASIA' THEN 'Asia Region' WHEN 'EUROPE' THEN 'Europe Region' END AS site_name
FROM sc"""

SQL["membership_flag"] = with_(SETTINGS) + """
SELECT win.hospitalization_id, CASE WHEN vent.hospitalization_id IS NULL THEN 0 ELSE 1 END AS Ventilator
FROM win LEFT JOIN vent USING (hospitalization_id)"""

SQL["curve_areas"] = with_(SCORED, LADDER) + """,
pts AS (
  SELECT site, rank, cum_neg::DOUBLE / N AS x, cum_pos::DOUBLE / P AS y,
         CASE WHEN P = 0 THEN 1.0 ELSE cum_pos::DOUBLE / P END AS r,
         cum_pos::DOUBLE / (cum_pos + cum_neg) AS p FROM lad
  UNION ALL SELECT DISTINCT site, 0, 0.0, 0.0, 0.0, 1.0 FROM lad),
seg AS (
  SELECT site, rank, x, y, r, p,
         LAG(x) OVER w AS x0, LAG(y) OVER w AS y0, LAG(r) OVER w AS r0, LAG(p) OVER w AS p0
  FROM pts WINDOW w AS (PARTITION BY site ORDER BY rank))
SELECT site, round(sum((x - x0) * (y + y0) * 0.5), 6) AS roc_auc_trapezoid,
       round(sum((r - r0) * (p + p0) * 0.5), 6) AS pr_auc
FROM seg WHERE rank > 0 GROUP BY site"""

SQL["label_probability_table"] = with_(SCORED) + "SELECT case_id, label, score AS pred_proba, site FROM sc"

SQL["lab_unit_filter"] = """
WITH labs AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS hospitalization_id,
         CASE l_returnflag WHEN 'R' THEN 'creatinine' WHEN 'A' THEN 'albumin' ELSE 'sodium' END AS lab_category,
         CASE l_linenumber % 3 WHEN 0 THEN 'mg/dL' WHEN 1 THEN 'g/dL' ELSE 'mmol/L' END AS reference_unit,
         CASE WHEN l_linestatus = 'O' THEN 'standard' ELSE 'poc' END AS lab_type_name,
         l_quantity AS lab_value
  FROM lineitem)
SELECT lab_category, reference_unit, count(*) AS n, round(avg(lab_value), 6) AS mean_value
FROM labs
WHERE (lab_category = 'creatinine' AND reference_unit = 'mg/dL' AND lab_type_name = 'standard')
   OR (lab_category = 'albumin' AND reference_unit = 'g/dL' AND lab_type_name = 'standard')
GROUP BY 1, 2"""

SQL["lab_standard_units"] = """
WITH labs AS (
  SELECT ['monocyte', 'lymphocyte', 'basophil', 'neutrophil', 'albumin', 'ast', 'total_protein', 'alkaline_phosphatase', 'bilirubin_total', 'bilirubin_conjugated', 'calcium', 'chloride', 'potassium', 'sodium', 'glucose_serum', 'hemoglobin', 'platelet count', 'wbc', 'lactate'][l_partkey % 19 + 1] AS lab_category,
         CASE WHEN l_suppkey % 17 <> 0 THEN ['%', 'K/uL', 'U/L', 'g/dL', 'mg/dL', 'mmol/L', 'g/L'][l_orderkey % 7 + 1] END AS reference_unit,
         CASE WHEN l_linestatus = 'O' THEN 'standard' ELSE 'poc' END AS lab_type_name,
         l_quantity AS lab_value
  FROM lineitem)
SELECT lab_category, reference_unit, count(*) AS n, round(avg(lab_value), 6) AS mean_value
FROM labs
WHERE (lab_category = 'monocyte' AND reference_unit = '%' AND lab_type_name = 'standard')
   OR (lab_category = 'lymphocyte' AND reference_unit = '%' AND lab_type_name = 'standard')
   OR (lab_category = 'basophil' AND reference_unit = '%' AND lab_type_name = 'standard')
   OR (lab_category = 'neutrophil' AND reference_unit = '%' AND lab_type_name = 'standard')
   OR (lab_category = 'albumin' AND reference_unit = 'g/dL' AND lab_type_name = 'standard')
   OR (lab_category = 'ast' AND reference_unit = 'U/L' AND lab_type_name = 'standard')
   OR (lab_category = 'total_protein' AND reference_unit = 'g/dL' AND lab_type_name = 'standard')
   OR (lab_category = 'alkaline_phosphatase' AND reference_unit = 'U/L' AND lab_type_name = 'standard')
   OR (lab_category = 'bilirubin_total' AND reference_unit = 'mg/dL' AND lab_type_name = 'standard')
   OR (lab_category = 'bilirubin_conjugated' AND reference_unit = 'mg/dL' AND lab_type_name = 'standard')
   OR (lab_category = 'calcium' AND reference_unit = 'mg/dL' AND lab_type_name = 'standard')
   OR (lab_category = 'chloride' AND reference_unit = 'mmol/L' AND lab_type_name = 'standard')
   OR (lab_category = 'potassium' AND reference_unit = 'mmol/L' AND lab_type_name = 'standard')
   OR (lab_category = 'sodium' AND reference_unit = 'mmol/L' AND lab_type_name = 'standard')
   OR (lab_category = 'glucose_serum' AND reference_unit = 'mg/dL' AND lab_type_name = 'standard')
   OR (lab_category = 'hemoglobin' AND reference_unit = 'g/dL' AND lab_type_name = 'standard')
   OR (lab_category = 'platelet count' AND reference_unit = 'K/uL' AND lab_type_name = 'standard')
   OR (lab_category = 'wbc' AND reference_unit = 'K/uL' AND lab_type_name = 'standard')
GROUP BY 1, 2"""

SQL["curve_areas_interpolated"] = with_(SCORED, LADDER) + """,
seg AS (
  SELECT site, P, cum_pos::DOUBLE AS tp, cum_neg::DOUBLE AS fp,
         COALESCE(LAG(cum_pos) OVER w, 0)::DOUBLE AS tp0, COALESCE(LAG(cum_neg) OVER w, 0)::DOUBLE AS fp0
  FROM lad WINDOW w AS (PARTITION BY site ORDER BY rank)),
line AS (
  SELECT *, (fp - fp0) / nullif(tp - tp0, 0) AS slope FROM seg),
area AS (
  SELECT site, P, CASE WHEN tp = tp0 THEN 0
                       WHEN fp0 = slope * tp0 THEN (tp - tp0) / (1 + slope)
                       ELSE (tp - tp0) / (1 + slope)
                            - (fp0 - slope * tp0) / ((1 + slope) * (1 + slope)) * (ln(tp + fp) - ln(tp0 + fp0)) END AS a
  FROM line)
SELECT site, round(sum(a) / nullif(max(P), 0), 6) AS pr_auc_interpolated FROM area GROUP BY site"""

SQL["table1_header"] = with_(SCORED) + """
SELECT site, regexp_replace('Overall(N=' || CAST(count(*) AS VARCHAR) || ')', 'Overall\\(N=(\\d+)\\)',
                            site || ' (N=\\1)') AS header
FROM sc GROUP BY site"""

SQL["source_scan"] = """
SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total_price
FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority"""


def _poisson_sql():
    return with_(SCORED) + """,
wt AS (SELECT site, case_id, label, score, label = 1 AS y, score >= 0.208 AS yh,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w0,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w1,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w2,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':0'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w3,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w4,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w5,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w6,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':1'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w7,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w8,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w9,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w10,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':2'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w11,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w12,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w13,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w14,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':3'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w15,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w16,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 9, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w17,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 17, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w18,
  (CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9810118431238462 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9963401531726562 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9994058151824182 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999897508033254 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999988747974021 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999998885745217 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999899522337 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999991683893 THEN 1 ELSE 0 END + CASE WHEN CAST(('0x' || substr(md5('42:' || case_id || ':4'), 25, 8)) AS BIGINT) / 4294967296.0 >= 0.9999999999364023 THEN 1 ELSE 0 END)::DOUBLE AS w19
  FROM sc WHERE label IS NOT NULL AND score IS NOT NULL),
agg AS (SELECT site,
  sum(w0) AS n0, sum(w0 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c0, sum(w0 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp0, sum(w0 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p0, sum(w0 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp0, sum(w0 * (score - label) * (score - label)) AS se0,
  sum(w1) AS n1, sum(w1 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c1, sum(w1 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp1, sum(w1 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p1, sum(w1 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp1, sum(w1 * (score - label) * (score - label)) AS se1,
  sum(w2) AS n2, sum(w2 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c2, sum(w2 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp2, sum(w2 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p2, sum(w2 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp2, sum(w2 * (score - label) * (score - label)) AS se2,
  sum(w3) AS n3, sum(w3 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c3, sum(w3 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp3, sum(w3 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p3, sum(w3 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp3, sum(w3 * (score - label) * (score - label)) AS se3,
  sum(w4) AS n4, sum(w4 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c4, sum(w4 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp4, sum(w4 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p4, sum(w4 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp4, sum(w4 * (score - label) * (score - label)) AS se4,
  sum(w5) AS n5, sum(w5 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c5, sum(w5 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp5, sum(w5 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p5, sum(w5 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp5, sum(w5 * (score - label) * (score - label)) AS se5,
  sum(w6) AS n6, sum(w6 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c6, sum(w6 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp6, sum(w6 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p6, sum(w6 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp6, sum(w6 * (score - label) * (score - label)) AS se6,
  sum(w7) AS n7, sum(w7 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c7, sum(w7 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp7, sum(w7 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p7, sum(w7 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp7, sum(w7 * (score - label) * (score - label)) AS se7,
  sum(w8) AS n8, sum(w8 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c8, sum(w8 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp8, sum(w8 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p8, sum(w8 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp8, sum(w8 * (score - label) * (score - label)) AS se8,
  sum(w9) AS n9, sum(w9 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c9, sum(w9 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp9, sum(w9 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p9, sum(w9 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp9, sum(w9 * (score - label) * (score - label)) AS se9,
  sum(w10) AS n10, sum(w10 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c10, sum(w10 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp10, sum(w10 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p10, sum(w10 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp10, sum(w10 * (score - label) * (score - label)) AS se10,
  sum(w11) AS n11, sum(w11 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c11, sum(w11 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp11, sum(w11 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p11, sum(w11 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp11, sum(w11 * (score - label) * (score - label)) AS se11,
  sum(w12) AS n12, sum(w12 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c12, sum(w12 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp12, sum(w12 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p12, sum(w12 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp12, sum(w12 * (score - label) * (score - label)) AS se12,
  sum(w13) AS n13, sum(w13 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c13, sum(w13 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp13, sum(w13 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p13, sum(w13 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp13, sum(w13 * (score - label) * (score - label)) AS se13,
  sum(w14) AS n14, sum(w14 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c14, sum(w14 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp14, sum(w14 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p14, sum(w14 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp14, sum(w14 * (score - label) * (score - label)) AS se14,
  sum(w15) AS n15, sum(w15 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c15, sum(w15 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp15, sum(w15 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p15, sum(w15 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp15, sum(w15 * (score - label) * (score - label)) AS se15,
  sum(w16) AS n16, sum(w16 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c16, sum(w16 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp16, sum(w16 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p16, sum(w16 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp16, sum(w16 * (score - label) * (score - label)) AS se16,
  sum(w17) AS n17, sum(w17 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c17, sum(w17 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp17, sum(w17 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p17, sum(w17 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp17, sum(w17 * (score - label) * (score - label)) AS se17,
  sum(w18) AS n18, sum(w18 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c18, sum(w18 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp18, sum(w18 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p18, sum(w18 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp18, sum(w18 * (score - label) * (score - label)) AS se18,
  sum(w19) AS n19, sum(w19 * CASE WHEN y = yh THEN 1.0 ELSE 0.0 END) AS c19, sum(w19 * CASE WHEN y AND yh THEN 1.0 ELSE 0.0 END) AS tp19, sum(w19 * CASE WHEN y THEN 1.0 ELSE 0.0 END) AS p19, sum(w19 * CASE WHEN yh THEN 1.0 ELSE 0.0 END) AS pp19, sum(w19 * (score - label) * (score - label)) AS se19
  FROM wt GROUP BY site),
lng AS (SELECT site, 0 AS r, n0 AS n, c0 AS c, tp0 AS tp, p0 AS p, pp0 AS pp, se0 AS se FROM agg
  UNION ALL SELECT site, 1 AS r, n1 AS n, c1 AS c, tp1 AS tp, p1 AS p, pp1 AS pp, se1 AS se FROM agg
  UNION ALL SELECT site, 2 AS r, n2 AS n, c2 AS c, tp2 AS tp, p2 AS p, pp2 AS pp, se2 AS se FROM agg
  UNION ALL SELECT site, 3 AS r, n3 AS n, c3 AS c, tp3 AS tp, p3 AS p, pp3 AS pp, se3 AS se FROM agg
  UNION ALL SELECT site, 4 AS r, n4 AS n, c4 AS c, tp4 AS tp, p4 AS p, pp4 AS pp, se4 AS se FROM agg
  UNION ALL SELECT site, 5 AS r, n5 AS n, c5 AS c, tp5 AS tp, p5 AS p, pp5 AS pp, se5 AS se FROM agg
  UNION ALL SELECT site, 6 AS r, n6 AS n, c6 AS c, tp6 AS tp, p6 AS p, pp6 AS pp, se6 AS se FROM agg
  UNION ALL SELECT site, 7 AS r, n7 AS n, c7 AS c, tp7 AS tp, p7 AS p, pp7 AS pp, se7 AS se FROM agg
  UNION ALL SELECT site, 8 AS r, n8 AS n, c8 AS c, tp8 AS tp, p8 AS p, pp8 AS pp, se8 AS se FROM agg
  UNION ALL SELECT site, 9 AS r, n9 AS n, c9 AS c, tp9 AS tp, p9 AS p, pp9 AS pp, se9 AS se FROM agg
  UNION ALL SELECT site, 10 AS r, n10 AS n, c10 AS c, tp10 AS tp, p10 AS p, pp10 AS pp, se10 AS se FROM agg
  UNION ALL SELECT site, 11 AS r, n11 AS n, c11 AS c, tp11 AS tp, p11 AS p, pp11 AS pp, se11 AS se FROM agg
  UNION ALL SELECT site, 12 AS r, n12 AS n, c12 AS c, tp12 AS tp, p12 AS p, pp12 AS pp, se12 AS se FROM agg
  UNION ALL SELECT site, 13 AS r, n13 AS n, c13 AS c, tp13 AS tp, p13 AS p, pp13 AS pp, se13 AS se FROM agg
  UNION ALL SELECT site, 14 AS r, n14 AS n, c14 AS c, tp14 AS tp, p14 AS p, pp14 AS pp, se14 AS se FROM agg
  UNION ALL SELECT site, 15 AS r, n15 AS n, c15 AS c, tp15 AS tp, p15 AS p, pp15 AS pp, se15 AS se FROM agg
  UNION ALL SELECT site, 16 AS r, n16 AS n, c16 AS c, tp16 AS tp, p16 AS p, pp16 AS pp, se16 AS se FROM agg
  UNION ALL SELECT site, 17 AS r, n17 AS n, c17 AS c, tp17 AS tp, p17 AS p, pp17 AS pp, se17 AS se FROM agg
  UNION ALL SELECT site, 18 AS r, n18 AS n, c18 AS c, tp18 AS tp, p18 AS p, pp18 AS pp, se18 AS se FROM agg
  UNION ALL SELECT site, 19 AS r, n19 AS n, c19 AS c, tp19 AS tp, p19 AS p, pp19 AS pp, se19 AS se FROM agg),
m AS (SELECT site, r, c / n AS Accuracy, CASE WHEN p = 0 THEN 0.0 ELSE tp / p END AS Recall,
             CASE WHEN pp = 0 THEN 0.0 ELSE tp / pp END AS "Precision", se / n AS "Brier Score Loss" FROM lng),
v AS (UNPIVOT m ON Accuracy, Recall, "Precision", "Brier Score Loss" INTO NAME metric VALUE val)
SELECT site, metric, round(quantile_cont(val, 0.025), 6) AS ci_lower, round(quantile_cont(val, 0.975), 6) AS ci_upper
FROM v GROUP BY site, metric"""


SQL["bootstrap_poisson_ci"] = _poisson_sql()


# ---- the configured study: feature tables and the model matrix -------------------------------
# fixed values: the registry's categories in the order in which event_id picks them
_VITALS = ["weight_kg", "heart_rate", "sbp", "dbp", "temp_c", "height_cm"]
_LABS = ["monocytes_percent", "lymphocytes_percent", "basophils_percent", "neutrophils_percent", "albumin", "ast",
         "total_protein", "alkaline_phosphatase", "bilirubin_total", "bilirubin_conjugated", "calcium_total", "chloride",
         "potassium", "sodium", "glucose_serum", "hemoglobin", "platelet_count", "wbc"]
_LAB_NAMES = {"monocytes_percent": "monocyte", "lymphocytes_percent": "lymphocyte", "basophils_percent": "basophil",
              "neutrophils_percent": "neutrophil", "calcium_total": "calcium"}


def _feature_ctes() -> str:
    def cat(names):
        return "CASE event_id % " + str(len(names)) + " " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END"

    def one(names):
        return ", ".join(f"min(x) FILTER (WHERE cat = '{n}') AS {n}" for n in names)

    inside = """ AS (
  SELECT o.hospitalization_id, date_trunc('hour', recorded_dttm) AS t, {cat} AS cat, {value} AS x
  FROM obs o JOIN cohort c USING (hospitalization_id)
  WHERE date_trunc('hour', recorded_dttm) >= c.min_in_dttm AND date_trunc('hour', recorded_dttm) <= c.after_24hr),
"""
    vit = ["bmi", "weight_kg", "pulse", "sbp", "dbp", "temp_c"]
    vit_cols = ", ".join(f"round({f}(w.{v}), 6) AS {n}_{v}" for v in vit for f, n in (("min", "min"), ("max", "max"), ("avg", "avg")))
    lab_cols = ", ".join(f"round({f}(w.{n}), 6) AS {_LAB_NAMES.get(n, n)}_{s}" for n in _LABS
                         for f, s in (("min", "min"), ("max", "max"), ("avg", "mean")))
    return (",\nvin" + inside.format(cat=cat(_VITALS), value="vital_value")
            + f"""vw0 AS (SELECT hospitalization_id, t, {one(_VITALS)} FROM vin GROUP BY 1, 2),
vw AS (SELECT *, heart_rate AS pulse, CASE WHEN height_cm = 0 THEN NULL
              ELSE weight_kg / ((height_cm / 100) * (height_cm / 100)) END AS bmi FROM vw0),
vfeat AS (SELECT c.hospitalization_id, {vit_cols} FROM cohort c LEFT JOIN vw w USING (hospitalization_id) GROUP BY 1),
lin""" + inside.format(cat=cat(_LABS), value="v")
            + f"""lw AS (SELECT hospitalization_id, t, {one(_LABS)} FROM lin GROUP BY 1, 2),
lfeat AS (SELECT c.hospitalization_id, {lab_cols} FROM cohort c LEFT JOIN lw w USING (hospitalization_id) GROUP BY 1)
""")


_INPUTS = (["isfemale", "age"] + [f"{s}_{v}" for v in ("bmi", "weight_kg", "pulse", "sbp", "dbp", "temp_c") for s in ("min", "max", "avg")]
           + [f"{v}_{s}" for v in sorted(_LAB_NAMES.get(n, n) for n in _LABS) for s in ("min", "max", "mean")])
_MATRIX = (",\ndemo AS (" + SQL["cohort_demographics"].split("\nSELECT c.hospitalization_id, c.patient_id", 1)[1].join(
    ["SELECT c.hospitalization_id, c.patient_id", ")"]) + """,
matrix AS (
  SELECT hospitalization_id, isdeathdispo AS label, race, ethnicity, sex, """
           + ", ".join("round(age, 6) AS age" if c == "age" else c for c in _INPUTS)
           + " FROM demo LEFT JOIN vfeat USING (hospitalization_id) LEFT JOIN lfeat USING (hospitalization_id))\n")
SQL["vital_features"] = with_(STAYS, ENC, COHORT, OBS).rstrip() + _feature_ctes() + "SELECT * FROM vfeat"
SQL["lab_features"] = with_(STAYS, ENC, COHORT, OBS).rstrip() + _feature_ctes() + "SELECT * FROM lfeat"
SQL["model_matrix"] = with_(STAYS, ENC, PATIENTS, COHORT, OBS).rstrip() + _feature_ctes() + _MATRIX + "SELECT * FROM matrix"
SQL["model_missingness"] = (with_(STAYS, ENC, PATIENTS, COHORT, OBS).rstrip() + _feature_ctes() + _MATRIX + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS na_count, count(*) AS total_rows, "
    f"CASE WHEN count(*) > 0 THEN (count(*) - count({c})) * 100.0 / count(*) END AS nan_percentage FROM matrix" for c in _INPUTS))


# ---- bootstrap replicates: every draw is a function of its counter -------------------------------------
def _thresholds(mean: int) -> str:
    """Poisson(mean) distribution function at 0, 1, ... in units of the prime, for means up to 8."""
    from math import ceil, exp
    term, acc, out = exp(-mean), 0.0, []
    for k in range(int(mean + 12 * mean ** 0.5 + 12) + 1):
        term = term * mean / k if k else term
        acc += term
        out.append(min(ceil(acc * 2147483647), 2147483647))
    return "[" + ", ".join(map(str, out)) + "]"


_WEIGHT = "CASE digit " + " ".join(f"WHEN {k} THEN len(list_filter({_thresholds(1 << k)}, lambda t: t <= x))" for k in range(4)) + " END"
_FIFTH = "((({0} * {0} % 2147483647) * ({0} * {0} % 2147483647) % 2147483647) * {0} % 2147483647)"
BOOT = """cell0 AS (
  SELECT site, score, sum(label)::BIGINT AS pos, (count(*) - sum(label))::BIGINT AS neg FROM sc WHERE score IS NOT NULL GROUP BY site, score),
cell1 AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY score DESC) AS rank FROM cell0),
cell AS (SELECT *, md5('42:' || coalesce(site, '') || ':' || rank) AS h FROM cell1),
digits AS (
  SELECT site, rank, score, cls, digit, ('0x' || substr(h, 1, 7))::BIGINT AS a, ('0x' || substr(h, 8, 7))::BIGINT AS b, ('0x' || substr(h, 15, 7))::BIGINT AS c
  FROM cell, (VALUES (0), (1)) k(cls), range(0, 4) d(digit) WHERE ((CASE cls WHEN 0 THEN pos ELSE neg END) >> digit) & 1 = 1),
draw0 AS (
  SELECT site, rank, score, cls, digit, b, c, r,
         (a + (r + 1) * 1103515245 % 2147483647 + (64 * cls + digit + 1) * 1140671485 % 2147483647) % 2147483647 AS x
  FROM digits, range(0, 1000) t(r)),
draw1 AS (SELECT site, rank, score, cls, digit, c, r, (""" + _FIFTH.format("x") + """ + b) % 2147483647 AS x FROM draw0),
draw2 AS (SELECT site, rank, score, cls, digit, r, (""" + _FIFTH.format("x") + """ + c) % 2147483647 AS x FROM draw1),
weight AS (SELECT site, rank, score, cls, r, """ + _WEIGHT + """ AS w FROM draw2),
cw AS (
  SELECT site, r, rank, any_value(score) AS score, sum(CASE WHEN cls = 0 THEN w ELSE 0 END)::DOUBLE AS p, sum(CASE WHEN cls = 1 THEN w ELSE 0 END)::DOUBLE AS q
  FROM weight GROUP BY site, r, rank),
cum AS (SELECT *, sum(p) OVER (PARTITION BY site, r ORDER BY rank) AS cp FROM cw),
rep AS (
  SELECT site, r, sum(p) AS p, sum(q) AS q, sum(CASE WHEN score >= 0.208 THEN p ELSE 0 END) AS tp, sum(CASE WHEN score >= 0.208 THEN q ELSE 0 END) AS fp,
         sum(p * (score - 1) * (score - 1) + q * score * score) AS se, sum(q * (cp - 0.5 * p)) AS u FROM cum GROUP BY site, r),
metric AS (
  SELECT site, 'Accuracy' AS metric, (tp + q - fp) / (p + q) AS v FROM rep
  UNION ALL SELECT site, 'Recall', CASE WHEN p = 0 THEN 0 ELSE tp / p END FROM rep
  UNION ALL SELECT site, 'Precision', CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END FROM rep
  UNION ALL SELECT site, 'ROC AUC', CASE WHEN p * q > 0 THEN u / (p * q) END FROM rep
  UNION ALL SELECT site, 'Brier Score Loss', se / (p + q) FROM rep),
ci AS (
  SELECT site, metric, round(quantile_cont(v, 0.025), 6) AS ci_lower, round(quantile_cont(v, 0.975), 6) AS ci_upper FROM metric GROUP BY site, metric)"""

SQL["bootstrap_ci"] = with_(SCORED, BOOT) + "SELECT site, metric, ci_lower, ci_upper, 1000 AS replicates FROM ci"
_POINT = "point AS (" + SQL["auc_brier"].split("m AS (SELECT", 1)[1].split("SELECT site, 'Accuracy'", 1)[1].join(["SELECT site, 'Accuracy'", ")"])
SQL["metrics_table"] = with_(SCORED, CONF, AUC, "m AS (SELECT conf.*, auc.auc FROM conf JOIN auc USING (site))", _POINT, BOOT) + """
SELECT point.site, point.metric, value, ci_lower, ci_upper
FROM point LEFT JOIN ci ON point.site IS NOT DISTINCT FROM ci.site AND point.metric = ci.metric"""
SQL["site_table_from_files"] = with_(SCORED, CONF, AUC, BOOT) + """,
one AS (SELECT conf.site, round(auc, 6) AS auc, round(brier, 6) AS brier, ci_lower AS auc_ci_lower, ci_upper AS auc_ci_upper
        FROM conf JOIN auc ON conf.site = auc.site JOIN ci ON ci.site = conf.site AND ci.metric = 'ROC AUC')
SELECT CASE site WHEN 'AFRICA' THEN 'Africa Region' WHEN 'AMERICA' THEN 'Americas Region' WHEN 'ASIA' THEN 'Asia Region'
                 WHEN 'EUROPE' THEN 'Europe Region' END AS site_name, *,
       CAST(row_number() OVER (ORDER BY auc DESC, site) AS INTEGER) AS auc_rank,
       CAST(row_number() OVER (ORDER BY brier ASC, site) AS INTEGER) AS brier_rank FROM one"""
