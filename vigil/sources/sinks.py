"""Sinks (SNK-1, SNK-2): row-level results stay partitioned by site; only aggregates are
shareable, and the shareable writer refuses frames that carry an identifier column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IDENTIFYING = ("hospitalization_id", "encounter_id", "patient_id", "case_id")
# One row per person: a score, or an outcome next to one.
SCORES = ("score", "pred_proba", "pred_prob", "probability", "y_pred_proba", "prediction")
OUTCOMES = ("label", "y_true", "isdeathdispo", "disposition")


def write_row_level(df: DataFrame, path: str, site_col: str = "site", mode: str = "overwrite") -> None:
    """Row-level output, one directory per site; stays on the site's own storage."""
    df.write.mode(mode).partitionBy(site_col).parquet(path)


def _shareable(df: DataFrame) -> None:
    bad = [c for c in df.columns if c.lower() in IDENTIFYING + SCORES + OUTCOMES]
    if bad:
        raise ValueError(f"refusing to share row-level columns: {bad}")


def write_shareable(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Small summary tables as one CSV with a header.  Raises on identifier columns and on
    row-level scores or outcomes (summaries name their columns after what they summarise)."""
    _shareable(df)
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def write_site_files(df: DataFrame, path: str, site_col: str = "site", mode: str = "overwrite") -> None:
    """A shareable summary as one CSV with a header per site (``{path}/site_dir=.../*.csv``); the site stays a column.
    Sites are dealt by their name, so each is written by one task."""
    _shareable(df)
    named = df.withColumn("site_dir", F.coalesce(F.col(site_col).cast("string"), F.lit("unnamed")))
    named.repartition("site_dir").write.mode(mode).partitionBy("site_dir").option("header", True).csv(path)
