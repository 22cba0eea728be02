"""Cohort operators: state blocks (WIN-1..4, AGG-1), first qualifying block (COH-1) and
demographics / outcome labels (COH-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import add_hours, death_flag, hours_between, map_values, trunc_ntz
from ..functions import fixed
from .ordered import join_on


def normalise_state(state: str, renames: dict | None = None) -> Column:
    """CND-2: upper-case the state; ``procedural`` (any case) becomes ``OR``."""
    col = F.upper(F.col(state))
    for src, dst in (renames if renames is not None else fixed.PROCEDURAL).items():
        col = F.when(col == F.lit(src.upper()), F.lit(dst.upper())).otherwise(col)
    return col


def _order_key(t_in: str, tie: str | None) -> Column:
    return F.struct(F.col(t_in).alias("t"), F.col(tie).alias("k")) if tie else F.struct(F.col(t_in).alias("t"))


def state_blocks(stays: DataFrame, *, id_col: str = "hospitalization_id",
                 state: str = "location_category", t_in: str = "in_dttm", t_out: str = "out_dttm",
                 tie: str | None = None, merge: dict | None = None, bucket: str | None = "DAY") -> DataFrame:
    """WIN-1..3 + AGG-1: number contiguous runs of the same state per id (block ids start
    at 1) and collapse each run to ``(id, block, state, min_in, max_out, n_rows)``.

    ``merge`` maps states onto another before the comparison (e.g. ``{"OR": "ICU"}``).
    NULL is a state of its own and compared null-safely (two NULL rows in a row share a
    block); the first row of an id always opens block 1.

    With ``bucket`` (a ``date_trunc`` unit) the ordered windows are partitioned by
    (id, time bucket), so one id with a huge history is spread over many tasks.  What
    crosses a bucket boundary -- the last state of the previous bucket and the number of
    blocks opened before -- comes from a per-(id, bucket) summary, which has one row per
    bucket and is small next to the rows.
    """
    st = F.col(state)
    for src, dst in (merge or {}).items():
        st = F.when(st == F.lit(src), F.lit(dst)).otherwise(st)
    key = F.struct(F.col(t_in).alias("t"), *([F.col(tie).alias("k")] if tie else []))
    x = stays.withColumn("_st", st).withColumn("_key", key)
    parts = [id_col] + (["_bk"] if bucket else [])
    if bucket:
        x = x.withColumn("_bk", trunc_ntz(bucket, t_in))
    w = Window.partitionBy(*parts).orderBy("_key")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("_prev", F.lag(F.struct(F.col("_st").alias("s"))).over(w))
    prev = F.col("_prev")
    chg = F.when(prev.isNull(), 1).when(prev["s"].eqNullSafe(F.col("_st")), 0).otherwise(1)
    x = x.withColumn("_first", prev.isNull()).withColumn("_c", chg).drop("_prev")
    if not bucket:
        x = x.withColumn("block", F.sum("_c").over(run))
    else:
        # local counts exclude the bucket's first row, whose change depends on the carry
        x = x.withColumn("_lc", F.sum(F.when(F.col("_first"), 0).otherwise(F.col("_c"))).over(run))
        summ = (x.groupBy(id_col, "_bk")
                .agg(F.min_by("_st", "_key").alias("_fs"), F.max_by("_st", "_key").alias("_ls"),
                     F.sum(F.when(F.col("_first"), 0).otherwise(F.col("_c"))).alias("_n_in")))
        wb = Window.partitionBy(id_col).orderBy("_bk")
        prev_b = F.lag(F.struct(F.col("_ls").alias("s"))).over(wb)
        summ = summ.withColumn("_fc", F.when(prev_b.isNull(), 1)
                               .when(prev_b["s"].eqNullSafe(F.col("_fs")), 0).otherwise(1))
        summ = summ.withColumn("_off", F.coalesce(
            F.sum(F.col("_fc") + F.col("_n_in")).over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        x = (join_on(x, summ.select(id_col, "_bk", "_fc", "_off"), [id_col, "_bk"])
             .withColumn("block", F.col("_off") + F.col("_fc") + F.col("_lc")))
    return (x.groupBy(id_col, "block")
            .agg(F.first("_st").alias(state), F.min(t_in).alias("min_in_dttm"),
                 F.max(t_out).alias("max_out_dttm"), F.count(F.lit(1)).alias("n_rows")))


def first_block(stays: DataFrame, encounters: DataFrame, *, id_col: str = "hospitalization_id",
                state: str = "location_category", t_in: str = "in_dttm", t_out: str = "out_dttm",
                tie: str | None = None, admit: str = "admission_dttm",
                age: str | None = "age_at_admission", target: str = fixed.ICU,
                merged: Sequence[str] = (fixed.OR_AS_ICU,), renames: dict | None = None,
                entry_hours: float = 48, horizon_hours: float = 72, min_hours: float = 24,
                window_hours: float = 24, admit_from: str | None = "2020-01-01",
                admit_before: str | None = "2022-01-01", min_age: float | None = 18,
                carry: dict | None = None) -> DataFrame:
    """COH-1: first contiguous ``target`` block (``merged`` states count as target) that
    starts within ``entry_hours`` of admission and lasts at least ``min_hours``.

    Rules, in order: the encounter qualifies when some target stay begins in
    [admission, admission + entry_hours], admission lies in [admit_from, admit_before)
    and age >= min_age.  Stays beginning after admission + horizon_hours are ignored.
    Rows before the first target stay are dropped; the first block runs from there to
    the first stay whose (merged) state differs (NULL differs).  An encounter whose
    first block is shorter than ``min_hours`` is dropped (no later block is tried).

    Built from grouped aggregates and key joins rather than per-id windows, so a hot
    encounter is pre-aggregated map-side and skewed join partitions can be split by AQE.
    Output: id, carried columns, min_in_dttm, max_out_dttm, after_{window_hours}hr.
    """
    carry = carry if carry is not None else {"patient_id": "patient_id",
                                              "age": "age_at_admission",
                                              "dispo": "discharge_category"}
    enc_cols = [id_col, admit] + sorted({c for c in carry.values()} | ({age} if age else set()))
    enc = encounters.select(*dict.fromkeys(enc_cols))
    cols = [id_col, state, t_in, t_out] + ([tie] if tie else [])
    s = (stays.select(*cols).join(enc, id_col, "left")
         .withColumn("_st", normalise_state(state, renames))
         .withColumn("_key", _order_key(t_in, tie))
         .withColumn("_in_h", F.col(t_in) <= add_hours(admit, horizon_hours)))
    is_target = F.col("_st") == F.lit(target)
    qual = (is_target & (F.col(t_in) >= F.col(admit))
            & (F.col(t_in) <= add_hours(admit, entry_hours)))
    if admit_from:
        qual = qual & (F.col(admit) >= F.lit(admit_from).cast("timestamp_ntz"))
    if admit_before:
        qual = qual & (F.col(admit) < F.lit(admit_before).cast("timestamp_ntz"))
    if age and min_age is not None:
        qual = qual & (F.col(age) >= F.lit(min_age))

    firsts = (s.groupBy(id_col)
              .agg(F.max(qual).alias("_q"),
                   F.min(F.when(is_target & F.col("_in_h"), F.col("_key"))).alias("_first"))
              .where(F.col("_q") & F.col("_first").isNotNull())
              .select(id_col, "_first"))
    tail = (s.where(F.col("_in_h")).join(firsts, id_col, "inner")
            .where(F.col("_key") >= F.col("_first")))
    in_block = F.col("_st").isin(target, *merged)
    breaks = tail.groupBy(id_col).agg(
        F.min(F.when(~F.coalesce(in_block, F.lit(False)), F.col("_key"))).alias("_brk"))
    block = (tail.join(breaks, id_col, "inner")
             .where(F.col("_brk").isNull() | (F.col("_key") < F.col("_brk"))))
    out = (block.groupBy(id_col)
           .agg(F.min(t_in).alias("min_in_dttm"), F.max(t_out).alias("max_out_dttm"),
                *[F.first(src, ignorenulls=True).alias(dst) for dst, src in carry.items()])
           .where(F.col("max_out_dttm") >= add_hours("min_in_dttm", min_hours))
           .withColumn(f"after_{_h(window_hours)}hr", add_hours("min_in_dttm", window_hours)))
    return out.select(id_col, *carry.keys(), "min_in_dttm", "max_out_dttm",
                      f"after_{_h(window_hours)}hr")


def _h(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else str(x).replace(".", "_")


def demographics(cohort: DataFrame, patients: DataFrame, *, key: str = "patient_id",
                 sex: str = "sex_category", race: str = "race_category",
                 ethnicity: str = "ethnicity_category", dispo: str = "dispo",
                 t_in: str = "min_in_dttm", t_out: str = "max_out_dttm",
                 death_pattern: str = fixed.DEATH_PATTERN) -> DataFrame:
    """COH-2: attach sex / race / ethnicity (left join on ``key``), drop rows without
    sex, derive ``isfemale``, ``isdeathdispo`` and ``ICU_stay_hrs``; race and ethnicity
    are harmonised with a default class for unmapped values."""
    p = patients.select(key, F.col(sex).alias("sex"), F.col(race).alias("_race"),
                        F.col(ethnicity).alias("_eth"))
    return (cohort.join(p, key, "left")
            .where(F.col("sex").isNotNull())
            .withColumns({
                "isfemale": (F.lower("sex") == F.lit("female")).cast("int"),
                "isdeathdispo": death_flag(dispo, death_pattern),
                "race": map_values("_race", fixed.RACE_MAP, fixed.RACE_DEFAULT),
                "ethnicity": map_values("_eth", fixed.ETHNICITY_MAP, fixed.ETHNICITY_DEFAULT),
                "ICU_stay_hrs": hours_between(t_in, t_out),
            })
            .drop("_race", "_eth"))


def membership_flag(df: DataFrame, members: DataFrame, key: str, name: str) -> DataFrame:
    """JON-4: 0/1 flag, 1 when ``key`` occurs in ``members``.  The member side is reduced
    to distinct keys first so the left join never fans out."""
    m = members.select(key).distinct().withColumn(name, F.lit(1))
    return df.join(m, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))
