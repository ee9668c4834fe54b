"""Exact numeric helpers.

PostgreSQL averages integers exactly (``numeric``) and ``::NUMERIC(p,s)``
rounds half away from zero.  Spark's ``avg`` is a double, which can land a
hair below an exact half cent, so averages are rebuilt from an integer sum
and a count and divided as decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_ratio(total: Column, count: Column, precision: int = 10, scale: int = 2) -> Column:
    """``total / count`` rounded half away from zero to ``decimal(p, s)``;
    NULL when ``count`` is 0.

    Both operands are integers (a SUM and a COUNT).  As ``decimal(20,0)`` the
    quotient keeps 18 fractional digits; a true quotient that is not exactly
    on a rounding boundary is at least ``1/(200*count)`` away from it, far
    more than the 18th digit, so the final cast (HALF_UP) rounds exactly as
    the database does for any count below 10**15.
    """
    t = total.cast("decimal(20,0)")
    c = count.cast("decimal(20,0)")
    return F.when(c > 0, (t / c).cast(f"decimal({precision},{scale})"))

