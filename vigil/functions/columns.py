"""Column-level helpers (STR, DAT, MAT, CND rows of the inventory).  All return
``Column`` expressions built from Spark built-ins, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def add_hours(ts, hours: float) -> Column:
    """DAT-2: ``ts + hours``; interval literal, so comparisons stay pushable."""
    return _c(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(hours) * 3600.0))


def hours_between(a, b) -> Column:
    """DAT-4: fractional hours from ``a`` to ``b`` (microsecond resolution)."""
    return F.timestamp_diff("MICROSECOND", _c(a), _c(b)) / F.lit(3.6e9)


def within(ts, lo, hi) -> Column:
    """JON-5 / FLT-4: ``lo <= ts <= hi`` (both ends inclusive)."""
    return (_c(ts) >= _c(lo)) & (_c(ts) <= _c(hi))


def death_flag(dispo, pattern: str = fixed.DEATH_PATTERN, default: str = "Other") -> Column:
    """STR-2/STR-4: 1 when the disposition matches the pattern (case-insensitive), NULL -> 0."""
    return F.coalesce(_c(dispo), F.lit(default)).rlike(f"(?i){pattern}").cast("int")


def lenient_number(c) -> Column:
    """Parse text to double; unparseable text (``'>90'``, ``'abc'``) becomes NULL."""
    return F.expr(f"try_cast({c} AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")


def strict_number(c) -> Column:
    """Parse text to double; unparseable text raises under ANSI mode."""
    return _c(c).cast("double")


def safe_div(a, b) -> Column:
    """MAT-1: ``a / b``, NULL when ``b`` is 0 or NULL (no ANSI division error)."""
    return F.try_divide(_c(a), _c(b))


def map_values(c, mapping: dict, default=None) -> Column:
    """JON-10 / CND-1: value lookup as a ``CASE`` chain; unmapped and NULL -> default."""
    col = _c(c)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == F.lit(k), F.lit(v)) if expr is None
                else expr.when(col == F.lit(k), F.lit(v)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def pao2_from_spo2(spo2) -> Column:
    """MAT-2: PaO2 imputed from SpO2 (percent); NULL when SpO2 >= 97 or missing."""
    s = _c(spo2) / F.lit(100.0)
    a = F.try_divide(F.lit(11700.0), F.try_divide(F.lit(1.0), s) - F.lit(1.0))
    b = F.sqrt(F.lit(50.0 ** 3) + a * a)
    return F.when(_c(spo2) < 97, F.cbrt(b + a) - F.cbrt(b - a))


def first_nonblank(c) -> Column:
    """FLT-11 helper: NULL for empty or blank text."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def parse_timestamp(c, fmt: str | None = None, strict: bool = False) -> Column:
    """DAT-1: text to ``timestamp_ntz``; unparseable text is NULL (lenient) or an error
    (``strict``, ANSI cast)."""
    col = _c(c)
    if strict:
        return (F.to_timestamp_ntz(col, F.lit(fmt)) if fmt else col.cast("timestamp_ntz"))
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz") if fmt else \
        F.try_to_timestamp(col).cast("timestamp_ntz")


def trunc_ntz(unit: str, c) -> Column:
    """``date_trunc`` that stays ``timestamp_ntz`` and ignores the session time zone
    (``date_trunc`` on a zone-less timestamp returns a zoned one).  Units: YEAR, QUARTER,
    MONTH, WEEK, DAY, HOUR, MINUTE."""
    col = _c(c)
    u = unit.upper()
    if u in ("YEAR", "QUARTER", "MONTH", "WEEK"):
        return F.trunc(F.to_date(col), u).cast("timestamp_ntz")
    if u == "DAY":
        return F.to_date(col).cast("timestamp_ntz")
    zero = F.lit(0)
    h = F.hour(col) if u in ("HOUR", "MINUTE") else zero
    m = F.minute(col) if u == "MINUTE" else zero
    if u not in ("HOUR", "MINUTE"):
        raise ValueError(f"unsupported unit {unit!r}")
    return F.make_timestamp_ntz(F.year(col), F.month(col), F.dayofmonth(col), h, m, F.lit(0).cast("decimal(8,6)"))
