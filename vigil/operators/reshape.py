"""Long <-> wide reshaping: EAV pivot (AGG-4), window features (FEA-1/2, AGG-2/3),
worst-value features (AGG-5), densify to a required domain (JON-9), unpivot (SET-3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from .temporal import window_join

_AGGS = {"min": F.min, "max": F.max, "mean": F.avg}


def dedupe_eav(long: DataFrame, *, keys: Sequence[str], cat: str, value: str,
               tie: Sequence[str] | str | None = None) -> DataFrame:
    """One value per (keys, category): the value of the first row in ``tie`` order (NULL
    values included), i.e. a deterministic ``first``; without ``tie`` the smallest value, NULL
    only if there is no other.  Partial aggregate: hot keys are
    reduced map-side."""
    order = [F.col(c) for c in ([tie] if isinstance(tie, str) else tie)] if tie else [F.col(value).isNull(), F.col(value)]
    return (long.groupBy(*keys, cat)
            .agg(F.min_by(F.col(value), F.struct(*order)).alias(value)))


def pivot_eav(long: DataFrame, *, keys: Sequence[str], cat: str, value: str,
              categories: Sequence[str], tie: Sequence[str] | str | None = None,
              names: dict | None = None) -> DataFrame:
    """AGG-4: long -> wide with one column per listed category (absent ones are NULL
    columns).  The category list is explicit, so no extra job discovers values."""
    d = dedupe_eav(long.where(F.col(cat).isin(*categories)), keys=keys, cat=cat, value=value, tie=tie)
    names = names or {}
    return d.groupBy(*keys).agg(*[
        F.max(F.when(F.col(cat) == F.lit(c), F.col(value))).alias(names.get(c, c))
        for c in categories])


def window_features(windows: DataFrame, obs: DataFrame, *, id_col: str, t: str, cat: str,
                    value: str, categories: Sequence[str], stats: Sequence[str] = ("min", "max", "mean"),
                    tie: Sequence[str] | str | None = None, name: str = "{cat}_{stat}",
                    lo: str = "min_in_dttm", hi: str = "after_24hr", keep_all: bool = True) -> DataFrame:
    """FEA-1/2: min / max / mean per (id, category) of observations inside the id's window.

    Order of work: window filter -> de-duplicate (id, time, category) with a deterministic
    first -> one conditional aggregate per (category, statistic).  That equals pivoting
    (id, time) to wide and aggregating each column, without materialising the wide rows.
    The window filter is an inner equi join (a hot id's observations can be split by AQE's
    skew handling, or the window side is broadcast when small); with ``keep_all`` the
    per-id result is left-joined to the window ids afterwards -- one row per id on both
    sides, so that join carries no skew.  Pin a computed cohort once (``session.pin``)
    when it feeds several feature tables.
    """
    o = obs.where(F.col(cat).isin(*categories))
    inside = window_join(windows, o, id_col=id_col, t=t, lo=lo, hi=hi)
    d = dedupe_eav(inside, keys=[id_col, t], cat=cat, value=value, tie=tie)
    aggs = [_AGGS[s](F.when(F.col(cat) == F.lit(c), F.col(value))).alias(name.format(cat=c, stat=s))
            for c in categories for s in stats]
    feats = d.groupBy(id_col).agg(*aggs)
    return windows.select(id_col).join(feats, id_col, "left") if keep_all else feats


def worst_values(long: DataFrame, *, id_col: str, t: str, cat: str, value: str,
                 worst_max: Sequence[str], worst_min: Sequence[str],
                 ranges: dict | None = None, floors: dict | None = None,
                 suffix_max: str = "_max", suffix_min: str = "_min") -> DataFrame:
    """AGG-5 / FLT-9: keep plausible rows (per-category [lo, hi] ranges or floors), take
    the worst value per (id, time, category) -- max for ``worst_max`` categories, min for
    ``worst_min`` -- then the worst over time per id.  NULL when a category is absent."""
    cond = None
    for c, (lo, hi) in (ranges or {}).items():
        e = (F.col(cat) == F.lit(c)) & F.col(value).between(lo, hi)
        cond = e if cond is None else cond | e
    for c, lo in (floors or {}).items():
        e = (F.col(cat) == F.lit(c)) & (F.col(value) >= lo)
        cond = e if cond is None else cond | e
    x = long.where(cond) if cond is not None else long
    x = x.where(F.col(value).isNotNull())
    # the per-time worst and then the worst over time collapse to one aggregate
    aggs = ([F.max(F.when(F.col(cat) == F.lit(c), F.col(value))).alias(c + suffix_max) for c in worst_max]
            + [F.min(F.when(F.col(cat) == F.lit(c), F.col(value))).alias(c + suffix_min) for c in worst_min])
    return x.groupBy(id_col).agg(*aggs)


def densify(agg: DataFrame, domain: Sequence[str], col: str) -> DataFrame:
    """JON-9: rows for exactly the required values, in ``domain`` order (``_order``);
    absent values give NULL rows and extra values are dropped.  The domain is a short
    literal list, so it is the broadcast side by construction."""
    spark = agg.sparkSession
    dom = spark.createDataFrame([(v, i) for i, v in enumerate(domain)], f"{col} string, _order int")
    return F.broadcast(dom).join(agg, col, "left")


def unpivot_columns(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "variable",
                    value: str = "value") -> DataFrame:
    """SET-3: wide -> long (``DataFrame.unpivot``); values are cast to double."""
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(ids), list(cols), var, value)


def filter_categories(long: DataFrame, cat: str, categories: Sequence[str], *, type_col: str | None = None,
                      type_value: str = "standard") -> DataFrame:
    """FLT-1/FLT-2: rows of the listed categories (one ``isin``, pushed to the scan), and
    optionally only rows whose type column equals ``type_value``."""
    cond = F.col(cat).isin(*categories)
    if type_col:
        cond = cond & (F.col(type_col) == F.lit(type_value))
    return long.where(cond)


def filter_pairs(long: DataFrame, allowed: Sequence[tuple], cols: Sequence[str]) -> DataFrame:
    """FLT-3: rows whose (category, unit, ...) tuple is in a short fixed list -- a left
    semi join against the list, which is a literal and therefore broadcast by construction."""
    spark = long.sparkSession
    ok = spark.createDataFrame([tuple(a) for a in allowed], ", ".join(f"{c} string" for c in cols))
    return long.join(F.broadcast(ok), list(cols), "left_semi")


def standard_labs(labs: DataFrame, *, cat: str = "lab_category", unit: str = "reference_unit",
                  type_col: str = "lab_type_name", allowed: Sequence[tuple] = tuple(fixed.LAB_UNITS)) -> DataFrame:
    """FLT-3 as the study uses it: results of type 'standard' whose (category, unit) is one of the 18
    accepted pairs.  The type and the categories reach the scan; the pairs are a semi join."""
    std = filter_categories(labs, cat, sorted({c for c, _ in allowed}), type_col=type_col)
    return filter_pairs(std, allowed, [cat, unit])
