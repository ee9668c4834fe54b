"""Operators the models are built from: surrogate keys, size-checked lookup
joins and data-quality checks."""

from .joins import DEFAULT_BROADCAST_BYTES, Size, fits_broadcast, lookup_join, measure
from .keys import sort_order, surrogate_key
from .quality import (
    Check,
    constraint_report,
    not_null,
    relationships,
    run_checks,
    star_matches,
    unique,
    unique_violations,
)

__all__ = [
    "DEFAULT_BROADCAST_BYTES",
    "Check",
    "Size",
    "constraint_report",
    "fits_broadcast",
    "lookup_join",
    "measure",
    "not_null",
    "relationships",
    "run_checks",
    "sort_order",
    "star_matches",
    "surrogate_key",
    "unique",
    "unique_violations",
]
