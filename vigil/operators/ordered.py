"""Order-dependent aggregates without a single-partition window.

``running_totals`` is a two-level prefix sum over a table that is written once to the shared folder, so that
the upstream is read once however many passes follow.  As long as some (group, bucket) has more than ``ROWS_PER_BUCKET`` rows, the buckets of such
pairs are split at quantiles of their own rows (a mergeable summary), so narrow ranges far from zero, such as epoch
seconds, spread over as many buckets as their rows need.  Any cuts give the same sums.  Each bucket's
totals form a small table whose own prefix sum gives per-bucket offsets; the running sum inside a
bucket is a window partitioned by (group, bucket), so no task needs more than one
bucket and a hot group is spread over many tasks.  ``exact_quantiles`` builds on it (linear
interpolation, the ``percentile`` / ``quantile_cont`` definition): a distinct value knows the
positions it covers, so it picks the quantiles that it answers itself, and one grouped
aggregate puts them together.

Group keys are compared null-safely throughout: rows whose key is NULL form a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: A bucket with more rows of one group is split, in ``CUTS`` + 1 parts at most.
ROWS_PER_BUCKET = 1_000_000
CUTS = 255


def join_on(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on ``keys`` in which NULL equals NULL: the keys travel as one struct, which is
    never NULL itself.  The keys are taken from ``df``."""
    key = F.struct(*[F.col(k) for k in keys])
    return df.withColumn("_jk", key).join(other.withColumn("_jk", key).drop(*keys), "_jk", how).drop("_jk")


def attach(df: DataFrame, small: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join per-group values onto rows.  With no group keys ``small`` is one row (a
    scalar), broadcast as such; otherwise an equi join on the keys whose strategy AQE
    picks from the measured size."""
    if by:
        return join_on(df, small, by)
    return df.crossJoin(F.broadcast(small))


def _place(cuts: F.Column, v: F.Column) -> F.Column:
    """Number of ``cuts`` (rising, ``CUTS`` at most) that are not above ``v``, by binary search; 0 without cuts or value."""
    steps = F.array(*[F.lit(1 << k) for k in range(CUTS.bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) <= v, at + step).otherwise(at))


def in_buckets(df: DataFrame, by: Sequence[str], order: str, rows: int | None = None) -> tuple[DataFrame, bool]:
    """``df``, written once, with its group ``_k`` and bucket ``_bk`` (rising with ``order``, which is unique within a group; NULL first),
    no (group, bucket) above ``rows`` rows; and whether there is more than one bucket."""
    rows = rows or ROWS_PER_BUCKET
    t, n = written(df.withColumn("_k", F.struct(F.lit(0).alias("_g"), *by)), "ordered", counted=True)
    t = t.withColumn("_bk", F.lit(0).cast("bigint"))
    v, split = F.col(order).cast("double"), False
    levels = 7 if n > rows else 0  # 256 ** 7 buckets; values that are equal as doubles cannot be parted
    for _ in range(levels):
        crowded = t.groupBy("_k", "_bk").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).drop("_n")
        parts = [F.lit(i / (CUTS + 1)) for i in range(1, CUTS + 1)]
        cuts = (t.select("_k", "_bk", v.alias("_v")).join(crowded, ["_k", "_bk"], "left_semi").groupBy("_bk")
                .agg(F.array_distinct(F.percentile_approx("_v", F.array(*parts), 20 * CUTS)).alias("_cuts")))
        cuts, more = written(cuts, "cuts", counted=True)
        if not more:
            break
        split = True
        t = t.join(cuts, "_bk", "left").withColumn("_bk", F.col("_bk") * (CUTS + 1) + _place(F.col("_cuts"), v)).drop("_cuts")
    return t, split


def running_totals(df: DataFrame, by: Sequence[str], order: str, sums: Sequence[str], *,
                   descending: bool = False, rows_per_bucket: int | None = None,
                   prefix: str = "cum_", totals_prefix: str | None = "tot_", leads: Sequence[str] = ()) -> DataFrame:
    """Add ``{prefix}{c}`` = running (inclusive) sum of ``c`` in ``order`` (numeric) within ``by``
    and, optionally, group totals ``{totals_prefix}{c}``.  ``order`` must be unique within
    a group (aggregate ties first).  ``leads`` adds ``next_{c}``, the value of ``c`` (never NULL itself) in the group's next row.
    With one bucket the offsets are all 0 and the windows hold whole groups of at most ``rows_per_bucket`` rows."""
    r, split = in_buckets(df, by, order, rows_per_bucket)
    o = F.col(order).desc() if descending else F.col(order).asc()
    bucket = ["_k", "_bk"] if split else ["_k"]
    j = r
    if split:
        opening = [(F.max_by if descending else F.min_by)(F.struct(*leads), F.col(order)).alias("_head")] if leads else []
        tot = r.groupBy("_k", "_bk").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums], *opening)
        # a window over bucket totals only: at most one row per bucket and group
        wb = Window.partitionBy("_k").orderBy(F.col("_bk").desc() if descending else F.col("_bk"))
        prev = wb.rowsBetween(Window.unboundedPreceding, -1)
        offs = [F.coalesce(F.sum(f"_t_{c}").over(prev), F.lit(0)).alias(f"_o_{c}") for c in sums]
        if totals_prefix:
            offs += [F.sum(f"_t_{c}").over(Window.partitionBy("_k")).alias(f"{totals_prefix}{c}") for c in sums]
        offs += [F.lead("_head").over(wb).alias("_next")] if leads else []
        j = r.join(tot.select("_k", "_bk", *offs), ["_k", "_bk"], "inner")
    wo = Window.partitionBy(*bucket).orderBy(o)
    wr = wo.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*bucket)
    new = {f"{prefix}{c}": F.sum(c).over(wr) + (F.col(f"_o_{c}") if split else F.lit(0)) for c in sums}
    if totals_prefix and not split:
        new |= {f"{totals_prefix}{c}": F.sum(c).over(whole) for c in sums}
    new |= {f"next_{c}": F.coalesce(F.lead(c).over(wo), F.col(f"_next.{c}")) if split else F.lead(c).over(wo) for c in leads}
    return j.withColumns(new).drop("_k", "_bk", "_next", *[f"_o_{c}" for c in sums])


def with_ends(df: DataFrame, by: Sequence[str], order: str, spread: int = 64) -> DataFrame:
    """Add each group's smallest and largest ``order`` as ``_mn`` and ``_mx``.  Rows meet them in ``spread`` shares of
    each group, by the value's hash, so that few groups don't mean few tasks."""
    r = df.withColumn("_bk", F.pmod(F.xxhash64(order), F.lit(spread))).withColumn("_k", F.struct(F.lit(0).alias("_g"), *by))
    whole = Window.partitionBy("_k")
    ends = (r.groupBy("_k", "_bk").agg(F.min(order).alias("_mn"), F.max(order).alias("_mx"))
            .select("_k", "_bk", F.min("_mn").over(whole).alias("_mn"), F.max("_mx").over(whole).alias("_mx")))
    return r.join(ends, ["_k", "_bk"]).drop("_k", "_bk")


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], *,
                    prob_col: str = "q", out: str = "value", rows_per_bucket: int | None = None,
                    keep_empty: bool = False) -> DataFrame:
    """Exact quantiles per group, linear interpolation between order statistics
    (position (n-1)q).  Rows ``(by..., q, value)``; NULL values are ignored and empty
    groups produce no rows, or NULL quantiles with ``keep_empty``.  Work is one aggregate to
    distinct values, one prefix sum and one aggregate of the values that hold a position."""
    by = list(by)
    if keep_empty:
        # groups whose values are all NULL stay (NULL quantiles): NULL gets count 0, so it
        # never holds a position and is left out of the group size
        cnt = df.groupBy(*by, value).agg(F.count(value).alias("_n"))
    else:
        cnt = (df.where(F.col(value).isNotNull()).groupBy(*by, value)
               .agg(F.count(F.lit(1)).alias("_n")))
    rt = running_totals(cnt, by, value, ["_n"], rows_per_bucket=rows_per_bucket, totals_prefix="_Ntot")
    return pick_positions(rt.withColumnRenamed("_Ntot_n", "_gtot"), by, value, probs, prob_col=prob_col, out=out)


def pick_positions(rt: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], *,
                   prob_col: str = "q", out: str = "value", carry: Sequence[str] = ()) -> DataFrame:
    """Quantiles from a distinct-value table ``(by..., value, _n, cum__n, _gtot)`` where
    ``cum__n`` counts rows with a value <= this one and ``_gtot`` is the group size.  A row covers the
    positions [cum__n - _n, cum__n) and answers the quantiles that need one of them.  With ``carry``
    those columns are added, as they stand at the smallest value >= the quantile."""
    last = F.col("_gtot") - 1
    lo = lambda q: F.floor(last.cast("double") * q)
    hi = lambda q: F.least(lo(q) + 1, last)
    holds = lambda p: (p >= F.col("cum__n") - F.col("_n")) & (p < F.col("cum__n"))
    qs = F.array(*[F.lit(float(p)) for p in probs])
    mine = F.filter(qs, lambda q: holds(lo(q)) | holds(hi(q)) | (F.col("_gtot") == 0))
    kept = F.struct(F.col(value).alias("v"), *[F.col(c) for c in carry])
    rows = rt.withColumn("_row", kept).select(*by, "_row", "_n", "cum__n", "_gtot", F.explode(mine).alias(prob_col))
    q = F.col(prob_col)
    at = (last.cast("double") * q) - lo(q)
    g = rows.groupBy(*by, prob_col).agg(F.max(F.when(holds(lo(q)), F.col("_row"))).alias("_lo"),
                                        F.max(F.when(holds(hi(q)), F.col("_row"))).alias("_hi"), F.max(at).alias("_f"))
    v = F.col("_lo.v") + F.col("_f") * (F.col("_hi.v") - F.col("_lo.v"))
    reach = F.when(v <= F.col("_lo.v"), F.col("_lo")).otherwise(F.col("_hi"))
    return g.select(*by, prob_col, v.alias(out), *[reach[c].alias(c) for c in carry])


def quantile_columns(df: DataFrame, by: Sequence[str], value: str, probs: dict,
                     rows_per_bucket: int | None = None, keep_empty: bool = False) -> DataFrame:
    """``exact_quantiles`` pivoted: one column per entry of ``probs`` (name -> q)."""
    q = exact_quantiles(df, by, value, list(probs.values()), rows_per_bucket=rows_per_bucket, keep_empty=keep_empty)
    return q.groupBy(*by).agg(*[F.max(F.when(F.col("q") == F.lit(float(p)), F.col("value"))).alias(name)
                                for name, p in probs.items()])
