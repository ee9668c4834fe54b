"""Generated sources: ``generate_series(date a, date b, interval '1 day')``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _as_date(d: str | dt.date) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


def date_series(spark: SparkSession, start: str | dt.date, end: str | dt.date,
                name: str = "date", partitions: int | None = None) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included.

    Built on ``spark.range`` so the days are spread over partitions rather
    than exploded from one row in one task.
    """
    first, last = _as_date(start), _as_date(end)
    n = (last - first).days + 1
    ids = spark.range(0, max(n, 0), 1, partitions) if partitions else spark.range(0, max(n, 0))
    return ids.select(F.date_add(F.lit(first), F.col("id").cast("int")).alias(name))
