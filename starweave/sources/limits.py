"""The declared limits of a table as aggregates: NOT NULL, VARCHAR(n) length
and NUMERIC(p, s) range.

The same aggregates count what breaks a limit in a report over a relation
(``operators.quality.constraint_report``) and, observed, in the pass that
writes a table (``sources.versions``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import PRIMARY_KEYS, columns


def numeric_misfit(c: Column, precision: int, scale: int,
                   kind: T.DataType | None = None) -> Column:
    """True when a value does not fit NUMERIC(p, s) once rounded to s digits.
    ``kind`` is the column's type, if known: a decimal with no more than s
    digits after the point needs no rounding and is compared as it is."""
    if isinstance(kind, T.DecimalType) and kind.scale <= scale:
        whole = precision - scale
        bound = F.lit(str(10 ** whole)).cast(T.DecimalType(min(38, whole + 1), 0))
        # Of another number of digits it could lose some in the comparison.
        if max(kind.precision - kind.scale, whole + 1) + kind.scale <= 38:
            return c.isNotNull() & (F.abs(c) >= bound)
    # The bound carries the value's scale: compared with a decimal(38,0)
    # Spark would widen to scale 0 and round 99999.9999 up to 100000.
    limit = F.lit(str(10 ** (precision - scale))).cast(f"decimal(38,{scale})")
    d = c.try_cast("decimal(38,18)")  # NULL when even this is too narrow
    return c.isNotNull() & (d.isNull() | (F.abs(F.round(d, scale)) >= limit))


def missing_columns(df: DataFrame, declared: str, left_out: Sequence[str] = (),
                    primary_key: str | None = None) -> list[str]:
    """Declared columns (the key too) that ``df`` lacks and that are not ``left_out``."""
    expected = [c.name for c in columns(declared)]
    pk = primary_key if primary_key is not None else PRIMARY_KEYS.get(declared)
    if pk and pk not in expected:
        expected.append(pk)
    return [c for c in expected if c not in df.columns and c not in left_out]


def limit_counts(df: DataFrame, declared: str) -> tuple[list[tuple[str, str]], list[Column]]:
    """(limit, column) and the aggregate that counts the rows breaking it, for
    every declared column that ``df`` has."""
    labels, aggs = [], []
    for c in columns(declared):
        if c.name not in df.columns:
            continue
        col = F.col(c.name)
        if c.not_null:
            labels.append(("not_null", c.name))
            aggs.append(F.count_if(col.isNull()))
        if c.max_length is not None:
            labels.append(("max_length", c.name))
            aggs.append(F.count_if(F.char_length(col) > c.max_length))
        if c.precision is not None:
            labels.append(("numeric_range", c.name))
            aggs.append(F.count_if(numeric_misfit(col, c.precision, c.scale,
                                                   df.schema[c.name].dataType)))
    return labels, aggs
