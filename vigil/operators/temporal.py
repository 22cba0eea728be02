"""Time-aware joins: window join (JON-5), as-of join (JON-6), first row per key (WIN-5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import trunc_ntz, within
from .ordered import join_on


def window_join(windows: DataFrame, obs: DataFrame, *, id_col: str, t: str,
                lo: str = "min_in_dttm", hi: str = "after_24hr", keep_bounds: bool = False) -> DataFrame:
    """Observations whose time lies in their id's window ``[lo, hi]`` (both inclusive).

    ``windows`` holds one window per id, so this is an equi join on the id with a
    residual range predicate (no range bucketing needed).  The join also restricts the
    observations to cohort ids (the semi join of the reference), and the time filter
    runs before any pivot or aggregate.  The strategy (broadcast or sort-merge) is left
    to adaptive execution, which measures the window side at run time.
    """
    w = windows.select(id_col, lo, hi)
    j = obs.join(w, id_col, "inner").where(within(t, lo, hi))
    return j if keep_bounds else j.drop(lo, hi)


def first_per_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """WIN-5: the first row per key by ``order`` (ascending, ``order`` should be a total
    order).  Uses ``min_by`` over a struct of all columns, a partial aggregate, so a hot
    key is reduced map-side instead of being sorted in one task."""
    key = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in key]
    best = F.min_by(F.struct(*rest), F.struct(*[F.col(c) for c in order])).alias("_r")
    return df.groupBy(*key).agg(best).select(*key, "_r.*")


def asof_join(left: DataFrame, right: DataFrame, *, id_col: str, left_t: str, right_t: str,
              values: Sequence[str], right_tie: str | None = None,
              bucket: str | None = "DAY", prefix: str = "") -> DataFrame:
    """JON-6: for every left row, the right row of the same id with the latest time at or
    before the left time (``roll = Inf``); NULLs when none exists.  Right values are
    carried as one struct, so a right row with NULL values still counts as "latest".  Right rows
    without id or time never match; left rows without id or time come back with NULLs.

    Plan: union both sides and take ``last(ignorenulls)`` over a window ordered by
    (time, side) -- right rows sort before left rows at equal times.  With ``bucket``
    (a ``date_trunc`` unit) the window is partitioned by (id, time bucket), so a hot id
    is spread over many tasks; left rows with no right row earlier in their bucket take
    the last right row of the nearest earlier bucket, found on a per-(id, bucket) summary
    that is tiny compared with the data.  No nested-loop or cross join is planned.
    """
    vals = list(values)
    tie = [right_tie] if right_tie else []
    lcols = left.columns
    placed = F.col(id_col).isNotNull() & F.col(left_t).isNotNull()
    right = right.where(F.col(id_col).isNotNull() & F.col(right_t).isNotNull())
    unplaced, left = left.where(~placed), left.where(placed)
    L = left.select(F.col(id_col).alias("_id"), F.col(left_t).alias("_t"), F.lit(1).alias("_side"),
                    F.struct(*[F.col(c) for c in lcols]).alias("_l"))
    rv = F.struct(F.col(right_t).alias("_rt"), *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie)],
                  *[F.col(c) for c in vals])
    R = right.select(F.col(id_col).alias("_id"), F.col(right_t).alias("_t"), F.lit(0).alias("_side"),
                     rv.alias("_r"))
    parts = ["_id"]
    if bucket:
        L = L.withColumn("_bk", trunc_ntz(bucket, "_t"))
        R = R.withColumn("_bk", trunc_ntz(bucket, "_t"))
        parts.append("_bk")
    u = L.unionByName(R, allowMissingColumns=True)
    order = [F.col("_t"), F.col("_side")] + [F.col(f"_r._tie{i}") for i in range(len(tie))]
    w = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = (u.withColumn("_m", F.last("_r", ignorenulls=True).over(w))
           .where(F.col("_side") == 1).select(*parts, "_l", "_m"))
    if bucket:
        # nearest earlier bucket's last right row, per (id, bucket) of the left side
        rlast = R.groupBy("_id", "_bk").agg(
            F.max_by("_r", F.struct(F.col("_t"), *[F.col(f"_r._tie{i}") for i in range(len(tie))]))
            .alias("_last"))
        # every (id, bucket) of the left side, taken from the left input itself so that the
        # windowed union above is computed once
        need = L.select("_id", "_bk").distinct()
        keys = need.join(rlast, ["_id", "_bk"], "full")
        wb = Window.partitionBy("_id").orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
        carry = (keys.withColumn("_prev", F.last("_last", ignorenulls=True).over(wb))
                 .where(F.col("_prev").isNotNull()).select("_id", "_bk", "_prev"))
        hit = (hit.join(carry, ["_id", "_bk"], "left")
               .withColumn("_m", F.coalesce("_m", "_prev")))
    out = hit.select("_l.*", *[F.col(f"_m.{c}").alias(prefix + c) for c in vals],
                     F.col("_m._rt").alias(prefix + right_t))
    kinds = {c: right.schema[c].dataType for c in [*vals, right_t]}
    return out.union(unplaced.select(*lcols, *[F.lit(None).cast(kinds[c]).alias(prefix + c) for c in [*vals, right_t]]))


def next_time(df: DataFrame, *, id_col: str, t: str, tie: str | None = None, out: str = "next_t",
              bucket: str | None = "DAY") -> DataFrame:
    """Time of the next row of the same id in (t, tie) order (``lead``), NULL for the last.

    With ``bucket`` the window is partitioned by (id, time bucket); a bucket's last row
    takes the first time of the id's next non-empty bucket from a per-(id, bucket) summary,
    so a hot id is not sorted in one task."""
    order = [F.col(t)] + ([F.col(tie)] if tie else [])
    if not bucket:
        return df.withColumn(out, F.lead(t).over(Window.partitionBy(id_col).orderBy(*order)))
    x = df.withColumn("_bk", trunc_ntz(bucket, t))
    x = x.withColumn(out, F.lead(t).over(Window.partitionBy(id_col, "_bk").orderBy(*order)))
    firsts = x.groupBy(id_col, "_bk").agg(F.min(t).alias("_ft"))
    nxt = firsts.withColumn("_nb", F.lead("_ft").over(Window.partitionBy(id_col).orderBy("_bk")))
    return (join_on(x, nxt.select(id_col, "_bk", "_nb"), [id_col, "_bk"])
            .withColumn(out, F.coalesce(F.col(out), F.col("_nb"))).drop("_bk", "_nb"))
