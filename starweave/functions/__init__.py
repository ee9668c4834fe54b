"""Scalar expressions used by the models (all built-in Spark functions)."""

from .dates import (
    date_from_key,
    date_key,
    day_name,
    days_between,
    leap_label,
    plus_months_minus_day,
)
from .numeric import rounded_ratio

__all__ = [
    "date_from_key",
    "date_key",
    "day_name",
    "days_between",
    "leap_label",
    "plus_months_minus_day",
    "rounded_ratio",
]
