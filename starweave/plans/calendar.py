"""Date parts: of the days of a calendar (``calendar_dim``) or of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_key, day_name, leap_label
from ..sources.series import date_series

# The calendar's first and last day.
CALENDAR_START = "2010-01-01"
CALENDAR_END = "2030-12-31"


def date_parts(days: DataFrame) -> DataFrame:
    """dateid (yyyymmdd int), year, quarter, month, ISO week, date, week_day
    (``mon``..``sun``) and the model's ``leap`` text of every row's ``date``."""
    d = F.col("date")
    return days.select(
        date_key(d).alias("dateid"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.weekofyear(d).alias("week"),
        d,
        day_name(d).alias("week_day"),
        leap_label(d).alias("leap"),
    )


def calendar_dim(spark: SparkSession, start: str = CALENDAR_START,
                 end: str = CALENDAR_END, partitions: int | None = None) -> DataFrame:
    """The date parts of every day from ``start`` to ``end``."""
    return date_parts(date_series(spark, start, end, partitions=partitions))
