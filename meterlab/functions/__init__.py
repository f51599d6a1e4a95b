"""Column expressions shared by the operators."""

from meterlab.functions.numeric import known, mean, not_a_number, number, total
from meterlab.functions.time import (
    bucket,
    from_micros,
    is_fixed_width,
    micros,
    months,
    parse_time,
    seconds_between,
    width_micros,
)

__all__ = [
    "bucket",
    "from_micros",
    "is_fixed_width",
    "known",
    "mean",
    "micros",
    "months",
    "not_a_number",
    "number",
    "parse_time",
    "seconds_between",
    "total",
    "width_micros",
]
