"""Scalar building blocks: coercions, percent keys, day arithmetic, join helpers."""

from .coerce import (
    for_report,
    key_as_string,
    to_decimal_or_zero,
    to_double_or_zero,
    to_timestamp_strict,
)
from .dates import add_days, as_of_date, as_of_midnight, duration_days
from .percent import (
    TIE_PERCENT,
    curve_percent_key,
    percent_first_days,
    leading_code,
    schedule_percent_key,
)

__all__ = [
    "TIE_PERCENT",
    "add_days",
    "as_of_date",
    "as_of_midnight",
    "curve_percent_key",
    "duration_days",
    "percent_first_days",
    "for_report",
    "key_as_string",
    "leading_code",
    "schedule_percent_key",
    "to_decimal_or_zero",
    "to_double_or_zero",
    "to_timestamp_strict",
]
