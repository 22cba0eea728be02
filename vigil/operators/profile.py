"""Profiling: describe (AGG-12), missingness (AGG-13), histograms (AGG-17), Table 1
(AGG-18), statistics transpose (SET-4).  Every statistic is one grouped aggregate over
the unpivoted columns; exact quantiles use the distributed prefix-sum operator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import quantile_columns

STATS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def _long(df: DataFrame, cols: Sequence[str], var: str = "feature", value: str = "value") -> DataFrame:
    return (df.select(F.lit(1).alias("_k"), *[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot(["_k"], list(cols), var, value).drop("_k"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-12: long (feature, statistic, value): non-null count, mean, sample sd, min,
    exact linear quartiles, max."""
    long = _long(df, cols)
    base = long.groupBy("feature").agg(F.count("value").cast("double").alias("count"), F.avg("value").alias("mean"),
                                       F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                                       F.max("value").alias("max"))
    q = quantile_columns(long, ["feature"], "value", {"25%": 0.25, "50%": 0.5, "75%": 0.75})
    wide = base.join(q, "feature", "left")
    return wide.unpivot(["feature"], STATS, "statistic", "value")


def transpose_stats(long: DataFrame, cols: Sequence[str], *, key: str = "statistic", var: str = "feature",
                    value: str = "value") -> DataFrame:
    """SET-4: one row per statistic, one column per feature (explicit list, no value
    discovery job)."""
    return long.groupBy(key).agg(*[F.max(F.when(F.col(var) == c, F.col(value))).alias(c) for c in cols])


def missingness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-13: (column, na_count, total_rows, nan_percentage) from ONE pass over the data."""
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    return (agg.unpivot(["_n"], list(cols), "column", "na_count")
            .select("column", F.coalesce("na_count", F.lit(0)).alias("na_count"), F.col("_n").alias("total_rows"),
                    F.try_divide(F.col("na_count") * 100.0, F.col("_n")).alias("nan_percentage")))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """AGG-17: equal-width bins between each feature's min and max (edges
    ``min + k * (max - min) / bins``), left-closed, the last bin closed on the right;
    only the counts (rows ``feature, bin, bin_lower, n``)."""
    num = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    # all smallest values and widths are one row; rows meet it as a scalar and are counted where they lie
    ends = num.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(cols) for f, n in ((F.min, "_mn"), (F.max, "_mx"))])
    ends = ends.select(*[x for i in range(len(cols)) for x in (F.col(f"_mn{i}"), ((F.col(f"_mx{i}") - F.col(f"_mn{i}")) / float(bins)).alias(f"_step{i}"))])

    def place(first: int, last: int) -> F.Column:
        """Number of edges that are not above the value: the edges rise, so each comparison halves them."""
        if first == last:
            return F.lit(first)
        k = (first + last + 1) // 2
        return F.when(F.lit(float(k)) * F.col("step") + F.col("lo") <= F.col("v"), place(k, last)).otherwise(place(first, k - 1))

    long = num.crossJoin(F.broadcast(ends)).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(c).alias("v"), F.col(f"_mn{i}").alias("lo"), F.col(f"_step{i}").alias("step")) for i, c in enumerate(cols)])))
    # rows are counted by one integer that holds feature and bin; names and edges are added to the counts
    n = (long.where(F.col("v").isNotNull()).select((F.col("i") * bins + place(0, bins - 1)).alias("at"))
         .groupBy("at").agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(ends)))
    i, b = F.floor(F.col("at") / bins).cast("int"), F.col("at") % bins
    of = lambda x: F.get(F.array(*[F.col(f"{x}{j}") for j in range(len(cols))]), i)
    return n.select(F.get(F.array(*map(F.lit, cols)), i).alias("feature"), b.alias("bin"), "n",
                    (b.cast("double") * of("_step") + of("_mn")).alias("bin_lower"))


def table1(df: DataFrame, *, continuous: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """AGG-18 / TAB-1: long (variable, level, statistic, value).  Continuous variables:
    n, mean, sd, median, min, max, missing.  Categorical: per level n and percent of the
    non-missing rows, and missing.  Also one row ('N', '', 'n', total rows)."""
    total = df.agg(F.count(F.lit(1)).cast("double").alias("_N"))
    parts = []
    if continuous:
        long = _long(df, continuous, "variable", "value")
        base = long.groupBy("variable").agg(
            F.count("value").cast("double").alias("n"), F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("sd"), F.min("value").alias("min"), F.max("value").alias("max"),
            F.sum(F.col("value").isNull().cast("double")).alias("missing"))
        med = quantile_columns(long, ["variable"], "value", {"median": 0.5})
        c = (base.join(med, "variable", "left")
             .unpivot(["variable"], ["n", "mean", "sd", "median", "min", "max", "missing"], "statistic", "value")
             .withColumn("level", F.lit("")))
        parts.append(c.select("variable", "level", "statistic", "value"))
    if categorical:
        cat = (df.select(F.lit(1).alias("_k"), *[F.col(v).cast("string").alias(v) for v in categorical])
               .unpivot(["_k"], list(categorical), "variable", "level").drop("_k"))
        cnt = cat.groupBy("variable", "level").agg(F.count(F.lit(1)).cast("double").alias("n"))
        known = cnt.where(F.col("level").isNotNull())
        denom = known.groupBy("variable").agg(F.sum("n").alias("_d"))
        lv = (known.join(denom, "variable")
              .select("variable", "level", "n", (F.col("n") * 100.0 / F.col("_d")).alias("pct"))
              .unpivot(["variable", "level"], ["n", "pct"], "statistic", "value"))
        miss = (cat.groupBy("variable").agg(F.sum(F.col("level").isNull().cast("double")).alias("value"))
                .select("variable", F.lit("").alias("level"), F.lit("missing").alias("statistic"), "value"))
        parts += [lv.select("variable", "level", "statistic", "value"), miss]
    parts.append(total.select(F.lit("N").alias("variable"), F.lit("").alias("level"), F.lit("n").alias("statistic"),
                              F.col("_N").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table1_header(df: DataFrame, site) -> DataFrame:
    """TAB-1 / STR-3: the column title of Table 1, ``Overall(N=n)`` rewritten to
    ``{site} (N=n)`` with a regular expression (one row per site value)."""
    site_col = F.col(site) if isinstance(site, str) and site in df.columns else F.lit(site)
    g = df.groupBy(site_col.alias("_site")).agg(F.count(F.lit(1)).alias("_n"))
    raw = F.concat(F.lit("Overall(N="), F.col("_n").cast("string"), F.lit(")"))
    return g.select(F.col("_site").alias("site"),
                    F.regexp_replace(raw, r"Overall\(N=(\d+)\)", F.concat(F.col("_site"), F.lit(" (N=$1)")))
                    .alias("header"))
