"""Lookup joins of a large table against a dimension.

A dimension is broadcast only after its size has been measured: one
aggregate over the dimension returns its row count and the bytes of its
columns.  Within the bound the join is a broadcast hash join: the large side
is never shuffled, so a hot key costs nothing extra.

Beyond the bound the join is one salted sort-merge join.  ``hot_keys`` finds
the keys that each hold at least ``hot_share`` of the large side's rows, for all
lookups in one pass, by mergeable frequent-items sketches; the set is small
enough to stand in the plan.  Their rows, and rows with a NULL key, which match
nothing, get a salt from a hash of the row; all other rows have salt 0.  The
dimension's rows of a hot key are repeated for every salt.  The sketches only
decide how rows are dealt out, never what they join to.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Default bound on what we broadcast: measured bytes of the dimension rows.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
# A key holding at least this share of the large side's rows is hot.
DEFAULT_HOT_SHARE = 1e-3


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int


def _width(field: T.StructField) -> Column:
    """Bytes a value takes in memory, roughly: strings by their UTF-8 length,
    everything else by a fixed width."""
    c = F.col(field.name)
    if isinstance(field.dataType, (T.StringType, T.VarcharType, T.CharType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8)
    if isinstance(field.dataType, T.DecimalType) and field.dataType.precision > 18:
        return F.lit(16)
    return F.lit(8)


def measure_all(dfs: Sequence[DataFrame]) -> list[Size]:
    """Row count and approximate bytes of each of ``dfs`` (one aggregate)."""
    parts = []
    for i, df in enumerate(dfs):
        row_bytes = F.lit(0)
        for f in df.schema.fields:
            row_bytes = row_bytes + _width(f)
        parts.append(df.select(F.lit(i).alias("i"), row_bytes.cast("long").alias("bytes")))
    found = reduce(DataFrame.unionAll, parts).groupBy("i").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes")).collect()
    sizes = {r["i"]: Size(int(r["rows"]), int(r["bytes"])) for r in found}
    return [sizes.get(i, Size(0, 0)) for i in range(len(dfs))]


def measure(df: DataFrame) -> Size:
    """Row count and approximate bytes of ``df``."""
    return measure_all([df])[0]


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether ``df`` is measured to fit ``max_bytes``.  Meant for tables and
    projections of tables: measuring a join would run it."""
    return measure(df).bytes <= max_bytes


def fitting_together(dims: Sequence[DataFrame], max_bytes: int = DEFAULT_BROADCAST_BYTES
                     ) -> list[bool]:
    """Which of ``dims`` to broadcast so that all of them together stay
    within ``max_bytes``: the smallest first, as many as fit."""
    return first_to_fit([s.bytes for s in measure_all(dims)], max_bytes)


def first_to_fit(sizes: Sequence[int], max_bytes: int) -> list[bool]:
    """Which of ``sizes`` stay within ``max_bytes`` together, the smallest first."""
    fits, total = [False] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: sizes[i]):
        total += sizes[i]
        fits[i] = total <= max_bytes
    return fits


def _tracked(share: float) -> int:
    """Counters of a frequent-items sketch whose error, 3.5 / counters of all
    rows, stays below half of ``share``."""
    return min(1_000_000, max(1_000, math.ceil(8 / share)))


def hot_keys(df: DataFrame, ons: Sequence[Sequence[str]], share: float = DEFAULT_HOT_SHARE
             ) -> list[list[int]]:
    """For each of the key column lists ``ons``, the hashes of the keys that hold
    at least ``share`` of the rows of ``df``; all in one pass over it.

    Every task folds its rows into one mergeable frequent-items sketch a
    list and the sketches are merged.  A sketch's counts are too high or low by less
    than half the share, so every hot key is found; a key found with at least half
    the share may not quite be hot, which costs nothing.  At most
    ``2 / share`` hashes a list come to the driver."""
    if not ons:
        return []
    most = min(100_000, math.ceil(2 / share))
    sketches = []
    for i, on in enumerate(ons):
        known = reduce(Column.__and__, [F.col(c).isNotNull() for c in on])
        # Rows with a NULL key match nothing and are salted anyway.
        hashed = F.when(known, F.xxhash64(*on))
        sketches.append(F.call_function("approx_top_k", hashed, F.lit(most),
                                        F.lit(max(_tracked(share), most))).alias(f"_t{i}"))
    row = df.agg(F.count(F.lit(1)).alias("_n"), *sketches).first()
    least = max(2.0, share * row["_n"] / 2)
    found = [[x["item"] for x in row[f"_t{i}"] or [] if x["item"] is not None and x["count"] >= least]
             for i in range(len(ons))]
    log.info("hot keys: %s", {",".join(on): len(f) for on, f in zip(ons, found)})
    return found


def salted_join(left: DataFrame, dim: DataFrame, on: Sequence[str], how: str,
                hot: Sequence[int], salts: int) -> DataFrame:
    """One sort-merge join on the key and a salt (see the module's text)."""
    on = list(on)
    columns = left.columns
    spread_out = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    dim_salts = F.array(F.lit(0))
    if hot:
        is_hot = F.xxhash64(*on).isin(list(hot))
        spread_out = spread_out | is_hot
        dim_salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(dim_salts)
    # A hash of the row, so a retried task deals its rows out as before.
    row_salt = F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")
    left = left.withColumn("_salt", F.when(spread_out, row_salt).otherwise(0))
    dim = dim.withColumn("_salt", F.explode(dim_salts))
    return left.join(dim.hint("merge"), [*on, "_salt"], how).drop("_salt")


def lookup_join(
    left: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    broadcast: bool | None = None,
    max_bytes: int = DEFAULT_BROADCAST_BYTES,
    hot_share: float | None = DEFAULT_HOT_SHARE,
    hot_from: DataFrame | None = None,
    hot: Sequence[int] | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Join ``left`` to ``dim`` on the named columns.

    ``dim`` is broadcast when it is measured to fit ``max_bytes`` (or when
    ``broadcast`` says so after an outside check).  Otherwise it is one
    sort-merge join with hot and NULL keys salted over ``salts`` (default:
    the session's shuffle partitions).  Hot keys are given by ``hot``, as
    ``hot_keys`` found them, or looked for in ``hot_from``, a table or a
    projection of one with the same keys.  Without either, or
    with ``hot_share=None``, only NULL keys are salted, and adaptive
    execution's skew handling covers the rest.  Full and right joins are not
    salted: a repeated dimension row would come out unmatched.
    """
    on = list(on)
    if broadcast is None:
        broadcast = fits_broadcast(dim, max_bytes)
    if broadcast:
        return left.join(F.broadcast(dim), on, how)
    if how not in ("left", "inner", "left_semi", "left_anti"):
        return left.join(dim.hint("merge"), on, how)
    if salts is None:
        salts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if hot is None and hot_share is not None and hot_from is not None:
        hot = hot_keys(hot_from, [on], hot_share)[0]
    return salted_join(left, dim, on, how, hot or [], max(1, salts))
