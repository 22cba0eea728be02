"""Multi-site comparison (EVL-13..16): every site's results are rows of one DataFrame
keyed by a site column (the per-site result files read with one glob)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def site_table(metrics: DataFrame, *, site: str = "site", metric: str = "metric", value: str = "value",
               auc_name: str = "ROC AUC", brier_name: str = "Brier Score Loss",
               lower: str | None = None, upper: str | None = None) -> DataFrame:
    """EVL-16: one row per site with AUC (and its CI when given) and Brier score, ranked
    by AUC descending and Brier ascending.  The input has one row per (site, metric), so
    the pivot is a conditional aggregate and the rank windows see one row per site."""
    aggs = [F.max(F.when(F.col(metric) == auc_name, F.col(value))).alias("auc"),
            F.max(F.when(F.col(metric) == brier_name, F.col(value))).alias("brier")]
    if lower and upper:
        aggs += [F.max(F.when(F.col(metric) == auc_name, F.col(lower))).alias("auc_ci_lower"),
                 F.max(F.when(F.col(metric) == auc_name, F.col(upper))).alias("auc_ci_upper")]
    t = metrics.groupBy(site).agg(*aggs)
    return (t.withColumn("auc_rank", F.row_number().over(Window.orderBy(F.desc("auc"), F.col(site))))
            .withColumn("brier_rank", F.row_number().over(Window.orderBy(F.asc("brier"), F.col(site)))))


def calibration_regression(cal: DataFrame, *, site: str = "site", x: str = "predicted_prob",
                           y: str = "actual_prob") -> DataFrame:
    """EVL-15 / AGG-16: least-squares slope and intercept of actual on predicted per site."""
    return cal.groupBy(site).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
