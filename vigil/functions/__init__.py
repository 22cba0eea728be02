from .columns import (
    add_hours, hours_between, within, death_flag, lenient_number, strict_number, safe_div,
    map_values, pao2_from_spo2, first_nonblank, parse_timestamp, trunc_ntz,
)
from . import fixed

__all__ = ["add_hours", "hours_between", "within", "death_flag", "lenient_number",
           "strict_number", "safe_div", "map_values", "pao2_from_spo2", "first_nonblank", "parse_timestamp", "trunc_ntz", "fixed"]
