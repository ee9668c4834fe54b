"""Dense surrogate keys: ``base + row_number() OVER (ORDER BY ...)``.

The models number a whole relation with no PARTITION BY.  Written as a
window, Spark would move every row into one task (``Exchange
SinglePartition``).  The two-pass form here stays parallel:

1. range-partition the rows on the full sort order and sort inside each
   partition; tag every row with its partition and its position in that
   partition (``monotonically_increasing_id`` right after the sort) and write
   the result as a parquet table under the session's checkpoint folder.
   This cuts lineage: range bounds come from a sample, and a recomputation
   after a lost executor must never see other partitions;
2. count rows per partition - a scan of one column, one row per partition,
   so only as many numbers as there are partitions reach the driver - and
   turn the counts into running offsets;
3. ``key = base + offset[partition] + position``; the offsets table is
   bounded by the partition count and is broadcast.

The sort order is the model's columns first, then every other column as a
tie-breaker, all ascending with NULLs last (the database's default).  The
order is then total up to equal rows, which are interchangeable, so the keys
are repeatable for any partition count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

_POSITION_BITS = 33  # monotonically_increasing_id: partition id << 33 | row


def sort_order(df: DataFrame, order_by: Sequence[str]) -> list[str]:
    """The model's sort columns followed by all remaining columns."""
    order = list(order_by)
    return order + [c for c in df.columns if c not in order]


def _ascending(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def surrogate_key(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    base: int = 100,
    partitions: int | None = None,
) -> DataFrame:
    """Prepend ``key`` (bigint, ``base + 1 .. base + n``) to the rows of ``df``.

    ``partitions`` fixes the range partition count; by default the session's
    shuffle partitions are used and adaptive execution may merge neighbours
    (merging keeps the ranges in order).
    """
    cols = df.columns
    order = _ascending(sort_order(df, order_by))
    ranged = (
        df.repartitionByRange(partitions, *order) if partitions
        else df.repartitionByRange(*order)
    ).sortWithinPartitions(*order)
    positioned = stored(_positioned(ranged, cols))
    return _numbered(positioned, key, cols, base)


def number_rows(df: DataFrame, key: str, base: int = 0) -> DataFrame:
    """``key`` (``base + 1 .. base + n``) for rows in no particular order: nothing is
    shuffled, positions are fixed in a written copy, which is then counted."""
    cols = df.columns
    return _numbered(stored(_positioned(df, cols)), key, cols, base)


def _positioned(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(
        F.monotonically_increasing_id().alias("_pos"), *cols
    ).select(
        F.shiftright("_pos", _POSITION_BITS).alias("_part"),
        (F.col("_pos").bitwiseAND((1 << _POSITION_BITS) - 1)).alias("_row"),
        *cols,
    )


def _numbered(positioned: DataFrame, key: str, cols: Sequence[str], base: int) -> DataFrame:
    # One row per partition (the count reads only the partition column); the
    # running offsets are fixed once here, so later evaluations of the result
    # are a scan and a hash lookup with no further job.
    sizes = sorted(tuple(r) for r in positioned.groupBy("_part").count().collect())
    if not sizes:
        return positioned.select(F.lit(None).cast("long").alias(key), *cols)
    offsets, total = [], 0
    for part, n in sizes:
        offsets.append(f"({int(part)}L, {total}L)")
        total += n
    # A VALUES list plans as a local relation: broadcasting it runs no job.
    offsets_df = positioned.sparkSession.sql(
        f"SELECT * FROM VALUES {', '.join(offsets)} AS t(_part, _offset)")
    return positioned.join(F.broadcast(offsets_df), "_part").select(
        (F.lit(base + 1).cast("long") + F.col("_offset") + F.col("_row")).alias(key),
        *cols,
    )
