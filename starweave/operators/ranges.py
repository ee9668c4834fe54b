"""Keys that occur more than once, looked for only where sorted ranges overlap.

A table written in key order, as every numbered model is, shows by itself that
its key is unique: the keys rise strictly inside a file, and the files' ranges
are disjoint.

1. Every task reads its keys in stored order and cuts them where they do not
   rise.  Of each run it sends the first and the last key, however many rows
   lie between.  A task with over ``RUNS`` runs is in no order: it sends its
   least and its largest key as one range that proves nothing.
2. Sorted by their first keys, runs overlap where one starts before all earlier
   ones have ended.  A key that occurs twice lies in such an overlap, or in a
   range that is in no order.
3. Only rows inside those intervals are left to be grouped.  The intervals
   are a filter on the key, so a scan skips the row groups of other ranges.

A clean table in key order ends with step 1, without a shuffle; of a table in
no order every row is left.  At most ``RUNS`` small rows a task reach the
driver, and at most ``INTERVALS`` intervals are named in the filter (beyond,
neighbours are merged, which leaves more rows and loses none).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNS = 8
INTERVALS = 100

# Types whose order is the same in Arrow, in Python and in a Spark filter.
_ORDERED = (T.StringType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(),
            T.DateType())


def sorted_runs(df: DataFrame, column: str, most: int = RUNS) -> DataFrame:
    """(lo, hi, rising): the strictly rising runs of the non-NULL keys, by task."""
    kind = df.schema[column].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, least, largest, arrow_type = [], None, None, None
        for batch in batches:
            keys = batch.column(0)
            if not len(keys):
                continue
            arrow_type = keys.type
            low, high = pc.min_max(keys).as_py().values()
            least = low if least is None else min(least, low)
            largest = high if largest is None else max(largest, high)
            if len(runs) > most:
                continue
            rises = pc.less(keys[:-1], keys[1:]).to_numpy(zero_copy_only=False).astype(bool)
            starts = [0, *(np.flatnonzero(~rises)[:most + 1] + 1).tolist()]
            for a, b in zip(starts, [*starts[1:], len(keys)]):
                first, last = keys[a].as_py(), keys[b - 1].as_py()
                if a == 0 and runs and runs[-1][1] < first:
                    runs[-1][1] = last  # goes on from the batch before
                else:
                    runs.append([first, last])
        if arrow_type is None:
            return
        rising = len(runs) <= most
        if not rising:
            runs = [[least, largest]]
        lo, hi = zip(*runs)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lo, arrow_type), pa.array(hi, arrow_type), pa.array([rising] * len(runs))],
            names=["lo", "hi", "rising"])

    return df.select(column).where(F.col(column).isNotNull()).mapInArrow(
        task, f"lo {kind}, hi {kind}, rising boolean")


def overlaps(runs: Iterable[tuple]) -> list[tuple]:
    """Closed intervals that hold every key which may occur twice in ``runs``."""
    found, reach = [], None
    for lo, hi, rising in sorted(runs):
        if not rising:
            found.append((lo, hi))
        elif reach is not None and lo <= reach:
            found.append((lo, min(hi, reach)))
        reach = hi if reach is None else max(reach, hi)
    return found


def merged(intervals: Iterable[tuple], most: int = INTERVALS) -> list[tuple]:
    """At most ``most`` disjoint intervals, ascending, that cover the given ones."""
    joined: list[list] = []
    for lo, hi in sorted(intervals):
        if joined and lo <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], hi)
        else:
            joined.append([lo, hi])
    step = max(1, -(-len(joined) // most))
    return [(joined[i][0], joined[min(i + step, len(joined)) - 1][1])
            for i in range(0, len(joined), step)]


def possible_repeats(df: DataFrame, column: str, most: int = RUNS) -> DataFrame | None:
    """The rows of ``df`` whose key may occur more than once; None if no key does.

    ``df`` is read for it, so it should be a written table.  Types without a
    common order (fractions, collated strings, ...) are left as they are."""
    if df.schema[column].dataType not in _ORDERED:
        return df
    intervals = merged(overlaps(map(tuple, sorted_runs(df, column, most).collect())))
    if not intervals:
        return None
    return df.where(reduce(lambda x, y: x | y,
                           [F.col(column).between(F.lit(lo), F.lit(hi)) for lo, hi in intervals]))
