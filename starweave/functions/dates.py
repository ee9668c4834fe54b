"""Date expressions of the models, as built-in Column expressions.

Everything here stays inside whole-stage codegen: no UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower-case three-letter day names, Sunday first (the order of
# Spark's dayofweek, 1 = Sunday).
DAY_NAMES = ("sun", "mon", "tue", "wed", "thu", "fri", "sat")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d: Column | str) -> Column:
    """``to_char(d, 'yyyymmdd')::int``: the int smart key of a date.

    Built arithmetically (year*10000 + month*100 + day), which needs neither
    a string nor the session time zone.  Spark's own ``date_format`` would
    need the pattern ``yyyyMMdd`` (``mm`` is minutes there).
    """
    d = _col(d)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def date_from_key(k: Column | str) -> Column:
    """``to_date(k::text, 'YYYYMMDD')``: back from a smart key to a date.

    NULL stays NULL; an impossible date raises under ANSI mode, as the
    database does.
    """
    k = _col(k)
    return F.make_date(
        F.call_function("div", k, F.lit(10000)).cast("int"),
        (F.call_function("div", k, F.lit(100)) % 100).cast("int"),
        (k % 100).cast("int"),
    )


def day_name(d: Column | str) -> Column:
    """``to_char(d, 'dy')``: lower-case three-letter day name (``wed``).

    Looked up from the day of the week, so no date formatter, locale or
    session time zone is involved."""
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.element_at(names, F.dayofweek(_col(d)))


def days_between(end: Column | str, start: Column | str) -> Column:
    """``end - start`` for two dates, as whole days (int)."""
    return F.datediff(_col(end), _col(start))


def plus_months_minus_day(d: Column | str, months: int = 2) -> Column:
    """``d + interval 'N month - 1 day'``: add months (clamping to the month
    end), then step back one day."""
    return F.date_sub(F.add_months(_col(d), months), 1)


def leap_label(d: Column | str) -> Column:
    """The calendar's ``leap`` text: ``'leap'`` when the day two months on,
    less a day, is the 29th.  This is true of Jan 1 in leap years but also of
    every 30th whose target month has a 30th and of July 31; the flag is kept
    as the model computes it."""
    return (
        F.when(F.dayofmonth(plus_months_minus_day(d)) == 29, F.lit("leap"))
        .otherwise(F.lit("not leap"))
    )
