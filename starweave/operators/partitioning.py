"""Input parallelism."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None) -> DataFrame:
    """Round-robin ``df`` over ``min_partitions`` partitions when its scan
    yields fewer (``None``: leave it as it is).

    A table stored as one large file with one row group is read by a single
    task, and everything streamed through broadcast joins after it would stay
    in that task.  Ask for it where a table is known to be stored so: the rows
    are shuffled, once for every consumer of a lazy plan.  ``df`` must be a
    plain scan, since asking a plan with shuffles for its partition count
    runs them.
    """
    if min_partitions is None or df.rdd.getNumPartitions() >= min_partitions:
        return df
    return df.repartition(min_partitions)
