"""Evaluation of a scored binary outcome (EVL-1..12).  Input: a DataFrame with a 0/1
label and a score, optionally group columns (site, subgroup).  Every curve is read off
the *score ladder*: one row per distinct score per group with positives, negatives and
their running totals from the highest score down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from .ordered import attach, join_on, pick_positions, running_totals, with_ends

div = F.try_divide


def score_ladder(df: DataFrame, *, label: str = "label", score: str = "score",
                 by: Sequence[str] = (), rows_per_bucket: int | None = None) -> DataFrame:
    """EVL-1: ``(by..., score, pos, neg, cum_pos, cum_neg, rank, P, N, next_pos, next_neg)``;
    cumulative counts include the row's own score (predicted positive at threshold = score), rank
    1 is the highest score, next is the one below (NULL for the last)."""
    by = list(by)
    lad = (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
           .groupBy(*by, F.col(score).alias("score"))
           .agg(F.sum(F.col(label).cast("long")).alias("pos"), F.count(F.lit(1)).alias("_n"))
           .withColumn("neg", F.col("_n") - F.col("pos")).drop("_n")
           .withColumn("one", F.lit(1).cast("long")))
    rt = running_totals(lad, by, "score", ["pos", "neg", "one"], descending=True, rows_per_bucket=rows_per_bucket,
                        leads=["pos", "neg"])
    return rt.select(*by, "score", "pos", "neg", "cum_pos", "cum_neg", F.col("cum_one").alias("rank"),
                     F.col("tot_pos").alias("P"), F.col("tot_neg").alias("N"), "next_pos", "next_neg")


def auc_from_ladder(lad: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC per group (Mann-Whitney form, ties count one half); NULL for one class."""
    by = list(by)
    return lad.groupBy(*by).agg(
        div(F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") * 0.5)),
            (F.first("P") * F.first("N")).cast("double")).alias("auc"))


def confusion(df: DataFrame, *, label: str = "label", score: str = "score", thr: float = fixed.THRESHOLD,
              by: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Counts at one threshold (``score >= thr``; ``>`` when ``strict``) plus Brier score
    and group size, in one aggregate."""
    yhat = (F.col(score) > thr) if strict else (F.col(score) >= thr)
    y = F.col(label) == 1
    c = lambda e: F.sum(F.when(e, 1).otherwise(0)).cast("long")
    return df.groupBy(*by).agg(
        c(~y & ~yhat).alias("tn"), c(~y & yhat).alias("fp"), c(y & ~yhat).alias("fn"),
        c(y & yhat).alias("tp"),
        F.avg((F.col(score) - F.col(label)) * (F.col(score) - F.col(label))).alias("brier"),
        F.count(F.lit(1)).alias("n"))


def rates(tn="tn", fp="fp", fn="fn", tp="tp", zero_as: float | None = None) -> dict:
    """Sensitivity, specificity, PPV, NPV, recall, accuracy; zero denominators give NULL
    (or ``zero_as``)."""
    def r(a, b):
        v = div(F.col(a).cast("double"), b.cast("double"))
        return v if zero_as is None else F.when(b == 0, F.lit(zero_as)).otherwise(v)
    tot = F.col(tn) + F.col(fp) + F.col(fn) + F.col(tp)
    return {
        "sensitivity": r(tp, F.col(tp) + F.col(fn)),
        "specificity": r(tn, F.col(tn) + F.col(fp)),
        "ppv": r(tp, F.col(tp) + F.col(fp)),
        "npv": r(tn, F.col(tn) + F.col(fn)),
        "recall": r(tp, F.col(tp) + F.col(fn)),
        "accuracy": div((F.col(tp) + F.col(tn)).cast("double"), tot.cast("double")),
    }


def metrics_at_threshold(df: DataFrame, *, label="label", score="score", thr=fixed.THRESHOLD,
                         by: Sequence[str] = ()) -> DataFrame:
    """EVL-7: one row per group: threshold, confusion counts and rates."""
    c = confusion(df, label=label, score=score, thr=thr, by=by)
    return c.select(*by, F.lit(float(thr)).alias("thr_value"), "tn", "fp", "fn", "tp",
                    *[v.alias(k) for k, v in rates().items()])


def headline_metrics(df: DataFrame, *, label="label", score="score", thr=fixed.THRESHOLD,
                     by: Sequence[str] = (), rows_per_bucket: int | None = None, lad: DataFrame | None = None) -> DataFrame:
    """EVL-2/EVL-4: long table (by..., metric, value) with Accuracy, Recall, Precision
    (at ``score >= thr``; 0 when the denominator is 0), ROC AUC (NULL for one class) and
    Brier Score Loss.  ``lad`` may pass the score ladder of the same rows."""
    by = list(by)
    c = confusion(df, label=label, score=score, thr=thr, by=by)
    lad = lad if lad is not None else score_ladder(df, label=label, score=score, by=by, rows_per_bucket=rows_per_bucket)
    auc = auc_from_ladder(lad, by)
    m = (join_on(c, auc, by, "left") if by else c.crossJoin(auc))
    rr = rates(zero_as=0.0)   # precision / recall of nothing called positive: 0, as sklearn scores it
    wide = m.select(*by, rr["accuracy"].alias("Accuracy"), rr["recall"].alias("Recall"),
                    rr["ppv"].alias("Precision"), F.col("auc").alias("ROC AUC"),
                    F.col("brier").alias("Brier Score Loss"))
    names = ["Accuracy", "Recall", "Precision", "ROC AUC", "Brier Score Loss"]
    return wide.unpivot(by, names, "metric", "value")


def roc_points(lad: DataFrame, by: Sequence[str] = (), drop_intermediate: bool = True) -> DataFrame:
    """EVL-10: (by..., fpr, tpr, threshold).  First point (0, 0, +inf); with
    ``drop_intermediate`` interior points whose neighbours continue on the same line are
    removed (a point stays when its step (pos, neg) differs from the next one, which the
    ladder carries)."""
    by = list(by)
    pts = lad
    if drop_intermediate:
        pts = lad.where((F.col("rank") == 1) | F.col("next_pos").isNull()
                        | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg")))
    pts = pts.select(*by, div(F.col("cum_neg").cast("double"), F.col("N").cast("double")).alias("fpr"),
                     div(F.col("cum_pos").cast("double"), F.col("P").cast("double")).alias("tpr"),
                     F.col("score").alias("threshold"), "cum_pos", "cum_neg", "P", "N")
    first = (lad.groupBy(*by).agg(F.first("P").alias("P"), F.first("N").alias("N"))
             .select(*by, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
                     F.lit(float("inf")).alias("threshold"), F.lit(0).cast("long").alias("cum_pos"),
                     F.lit(0).cast("long").alias("cum_neg"), "P", "N"))
    return pts.unionByName(first)


def pr_points(lad: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """EVL-11: (by..., precision, recall, threshold) at every distinct score, plus the
    closing point precision 1, recall 0 with threshold 1."""
    by = list(by)
    pts = lad.select(*by, div(F.col("cum_pos").cast("double"), (F.col("cum_pos") + F.col("cum_neg")).cast("double"))
                     .alias("precision"),
                     F.when(F.col("P") == 0, F.lit(1.0))
                     .otherwise(div(F.col("cum_pos").cast("double"), F.col("P").cast("double"))).alias("recall"),
                     F.col("score").alias("threshold"))
    last = lad.select(*by).distinct().select(*by, F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
                                             F.lit(1.0).alias("threshold"))
    return pts.unionByName(last)


def curve_areas(lad: DataFrame, by: Sequence[str] = (), pr: str = "trapezoid") -> DataFrame:
    """EVL-10/11: trapezoid areas under the ROC curve (fpr, tpr) and the PR curve
    (recall, precision) through every ladder point, starting at (0, 0) for ROC and at
    recall 0, precision 1 for PR.  The point before a row's is its running totals without its own
    counts, so each row gives its own trapezoid: no join and no window.

    ``pr="interpolated"`` measures the PR area between achievable points instead: inside a ladder row
    (tied scores) false positives grow linearly with true positives, so precision bends with recall.
    A row of ``pos`` > 0 positives has the closed form below; a row without any has width 0."""
    if pr not in ("trapezoid", "interpolated"):
        raise ValueError(f"pr is trapezoid or interpolated, not {pr!r}")
    by = list(by)
    p, n = F.col("P").cast("double"), F.col("N").cast("double")
    cp, cn = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    bp, bn = (F.col("cum_pos") - F.col("pos")).cast("double"), (F.col("cum_neg") - F.col("neg")).cast("double")
    first = F.col("rank") == 1
    recall = lambda c: F.when(p == 0, 1.0).otherwise(div(c, p))
    r0, p0 = F.when(first, 0.0).otherwise(recall(bp)), F.when(first, 1.0).otherwise(div(bp, bp + bn))
    area = (recall(cp) - r0) * (div(cp, cp + cn) + p0) * 0.5
    if pr == "interpolated":
        # with t true positives, t / (w t + c) is the precision: w = 1 + neg / pos, c what precedes the row
        w = 1 + div(F.col("neg").cast("double"), F.col("pos").cast("double"))
        c = bn - (w - 1) * bp
        bend = F.when((bp + bn > 0) & (c != 0), c / (w * w) * F.ln(div(cp + cn, bp + bn))).otherwise(0.0)
        area = div(F.when(F.col("pos") > 0, F.col("pos") / w - bend).otherwise(0.0), p)
    return lad.groupBy(*by).agg(
        F.sum((div(cn, n) - div(bn, n)) * (div(cp, p) + div(bp, p)) * 0.5).alias("roc_auc_trapezoid"),
        F.sum(area).alias("pr_auc"))


def threshold_metrics(roc: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """EVL-12: accuracy, recall, precision at each ROC threshold (precision 0 when nothing
    is called positive)."""
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    n = (F.col("P") + F.col("N")).cast("double")
    return roc.select(*by, "threshold",
                      div((tp + (F.col("N") - fp)).cast("double"), n).alias("accuracy"),
                      div(tp.cast("double"), F.col("P").cast("double")).alias("recall"),
                      F.when(tp + fp == 0, F.lit(0.0)).otherwise(div(tp.cast("double"), (tp + fp).cast("double")))
                      .alias("precision"))


def topn_sweep(df: DataFrame, *, label="label", score="score", by: Sequence[str] = (),
               steps: int = fixed.SWEEP_STEPS, include_top: bool = True,
               rows_per_bucket: int | None = None, lad: DataFrame | None = None) -> DataFrame:
    """EVL-6: for q = 1.00, 0.99, ..., 1/steps: threshold = linear quantile q of the score,
    counts of ``score >= threshold``.  ``include_top=False`` starts at (steps-1)/steps
    (99 rows from 0.99, the R variant).  Quantile positions and counts are looked up on
    the ladder's rows themselves: one pass over the data, not one per threshold."""
    by = list(by)
    top = steps if include_top else steps - 1
    probs = [k / float(steps) for k in range(top, 0, -1)]
    lad = lad if lad is not None else score_ladder(df, label=label, score=score, by=by, rows_per_bucket=rows_per_bucket)
    # quantiles of the score read off the same ladder: ascending position of a distinct
    # score = rows below it + its own count (no second pass over the data)
    asc = lad.select(*by, F.col("score"), (F.col("pos") + F.col("neg")).alias("_n"),
                     ((F.col("P") + F.col("N")) - (F.col("cum_pos") + F.col("cum_neg"))
                      + (F.col("pos") + F.col("neg"))).alias("cum__n"),
                     (F.col("P") + F.col("N")).alias("_gtot"), "cum_pos", "cum_neg", "P", "N")
    # rows with score >= threshold: the threshold is an order statistic or lies between two
    # adjacent ones, so the count is the ladder's running total at the lower statistic
    # (threshold equal to it) or at the upper one
    hit = pick_positions(asc, by, "score", probs, out="thr_value", carry=("cum_pos", "cum_neg", "P", "N"))
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    out = hit.select(*by, "q", "thr_value", (F.col("N") - fp).alias("tn"), fp.alias("fp"),
                     (F.col("P") - tp).alias("fn"), tp.alias("tp"))
    return out.select("*", *[v.alias(k) for k, v in rates().items()],
                      F.concat(F.lit("Top "), F.round((F.lit(1.0) - F.col("q")) * 100, 0).cast("string"),
                               F.lit("%")).alias("n_percentile"))


def net_benefit(sweep: DataFrame) -> DataFrame:
    """EVL-13: (TP - FP * t / (1 - t)) / n at each sweep threshold t; NULL at t = 1."""
    t = F.col("thr_value")
    n = (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).cast("double")
    odds = div(t, F.lit(1.0) - t)
    return sweep.withColumn("net_benefit", div(F.col("tp") - F.col("fp") * odds, n))


def nearest_threshold(df: DataFrame, by: Sequence[str], target: float = fixed.THRESHOLD,
                      col: str = "thr_value", then_desc: Sequence[str] = ("q",)) -> DataFrame:
    """EVL-14 / WIN-6: the row whose ``col`` is nearest ``target`` per group.  Ties go to
    the row that comes first in the sweep's own order (higher value, then higher
    ``then_desc`` columns), as a first-occurrence arg-min does.  ``min_by`` is a partial
    aggregate."""
    rest = [c for c in df.columns if c not in by]
    key = F.struct(F.abs(F.col(col) - target), -F.col(col), *[-F.col(c) for c in then_desc])
    return (df.groupBy(*by).agg(F.min_by(F.struct(*rest), key).alias("_r")).select(*by, "_r.*"))


def calibration_equal_width(df: DataFrame, *, label="label", score="score", by: Sequence[str] = (),
                            n_bins: int = fixed.CALIBRATION_BINS) -> DataFrame:
    """EVL-8: equal-width bins between each group's min and max score, right-closed with
    the lowest edge included; bin = number of interior edges strictly below the score.
    Mean predicted, mean actual, n, se = sqrt(p(1-p)/n), p -/+ 1.96 se.  Empty bins are
    absent.  Bins are found for distinct scores, which carry their rows' counts."""
    by = list(by)
    cells = (df.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).alias(score))
             .agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(label).cast("double")).alias("_y"), F.count(label).alias("_ny")))
    x = with_ends(cells, by, score)
    step = (F.col("_mx") - F.col("_mn")) / float(n_bins)
    b = sum((F.when(F.lit(float(k)) * step + F.col("_mn") < F.col(score), 1).otherwise(0)
             for k in range(1, n_bins)), F.lit(0))
    g = (x.withColumn("bin", b.cast("int")).groupBy(*by, "bin")
         .agg(div(F.sum(F.col(score) * F.col("_n")), F.sum("_n")).alias("predicted_prob"),
              div(F.sum("_y"), F.sum("_ny")).alias("actual_prob"), F.sum("_n").alias("n")))
    se = F.sqrt(F.col("actual_prob") * (1 - F.col("actual_prob")) / F.col("n"))
    return g.withColumn("se", se).withColumns({"lower_ci": F.col("actual_prob") - 1.96 * F.col("se"),
                                               "upper_ci": F.col("actual_prob") + 1.96 * F.col("se")})


def calibration_fixed_edges(df: DataFrame, *, label="label", score="score", by: Sequence[str] = (),
                            edges: Sequence[float] = tuple(fixed.FIXED_EDGES)) -> DataFrame:
    """EVL-9: left-closed bins on fixed edges; bin i = number of edges <= score, labelled
    by edge i (the last bin keeps the number len(edges))."""
    idx = sum((F.when(F.lit(float(e)) <= F.col(score), 1).otherwise(0) for e in edges), F.lit(0))
    lab = F.element_at(F.array(*[F.lit(float(e)) for e in edges]), (idx + 1).cast("int"))
    val = F.when(idx < len(edges), lab).otherwise(F.lit(float(len(edges))))
    return (df.where(F.col(score).isNotNull()).withColumn("prob_bin_val", val)
            .groupBy(*by, "prob_bin_val")
            .agg(F.avg(F.col(label).cast("double")).alias("actual_prob"), F.avg(score).alias("predicted_prob"),
                 F.count(F.lit(1)).alias("n")))


def fairness(df: DataFrame, *, subgroups: Sequence[str], label="label", score="score",
             thr: float = fixed.THRESHOLD, by: Sequence[str] = (), strict: bool = True,
             rows_per_bucket: int | None = None) -> DataFrame:
    """EVL-5: per (by..., subgroup column, group value): confusion counts at the threshold
    (``score > thr`` by default, as in the reference's fairness table), AUC, PPV,
    sensitivity, specificity, NPV, recall, accuracy (zero denominators -> 0), Brier,
    group count, total count and proportion.  Groups with one class get NULL metrics (the
    counts are still given).  The subgroup columns are unpivoted so that ONE grouped
    aggregate and ONE ladder serve them all; rows with a NULL group value are dropped."""
    by = list(by)
    total = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total_count"))
    long = (df.select(*by, label, score, *[F.col(s).cast("string").alias(s) for s in subgroups])
            .unpivot(by + [label, score], list(subgroups), "subgroup", "group_value")
            .where(F.col("group_value").isNotNull()))
    keys = by + ["subgroup", "group_value"]
    c = confusion(long, label=label, score=score, thr=thr, by=keys, strict=strict)
    auc = auc_from_ladder(score_ladder(long, label=label, score=score, by=keys, rows_per_bucket=rows_per_bucket), keys)
    two = (F.col("tp") + F.col("fn") > 0) & (F.col("tn") + F.col("fp") > 0)
    rr = rates(zero_as=0.0)
    m = attach(join_on(c, auc, keys, "left"), total, by) if by else join_on(c, auc, keys, "left").crossJoin(F.broadcast(total))
    return m.select(*keys, "tn", "tp", "fp", "fn",
                    F.when(two, F.col("auc")).alias("auc"),
                    *[F.when(two, rr[k]).alias(k) for k in ("ppv", "sensitivity", "specificity", "npv", "recall",
                                                            "accuracy")],
                    F.when(two, F.col("brier")).alias("brier_score"),
                    F.col("n").alias("group_count"), "total_count",
                    (F.col("n") / F.col("total_count")).alias("proportion"))
