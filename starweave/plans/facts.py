"""``sales_fact``: staging rows with the four dimension keys looked up.

Every lookup is a LEFT join on the business columns, with plain equality
(a NULL never matches, so a NULL postal code leaves ``geo_id`` NULL and the
geography match ignores country).  A business key that appears in several
dimension rows repeats the order line once per row, as the model does.

Plan: the dimensions are measured and, smallest first, broadcast as long as
all of them together fit the bound, so the fact is streamed once through hash
lookups with no shuffle.  A dimension beyond the bound is joined with a
salted sort-merge join, and what it shuffles is kept narrow: date keys are made
before all lookups, and broadcast dimensions that hold a business key once
are looked up first, so that a number is shuffled in place of their text columns.
Broadcast dimensions that repeat a key come last, so the order lines are
shuffled before any fan-out of theirs multiplies them.  A dimension beyond the
bound whose rows of a business key are numbered one after the other (as
numbering in the key's order makes them) is looked up as one row per business
key, its first number and how many; that may fit the bound, and the
order line is repeated after all lookups.
Independent left joins commute, so the order does not change the result.  Hot
and NULL business keys are salted; the hot ones of all shuffled lookups are found
in one more pass over the staging rows' key columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..operators.joins import (
    DEFAULT_BROADCAST_BYTES,
    DEFAULT_HOT_SHARE,
    first_to_fit,
    hot_keys,
    lookup_join,
    measure,
    measure_all,
)
from ..session import stored

# The columns carried over from the order lines.
MEASURES = ("order_id", "sales", "profit", "quantity", "discount")


def dimension_lookups(customer: DataFrame, product: DataFrame, shipping: DataFrame,
                      geo: DataFrame) -> list[tuple[DataFrame, list[str]]]:
    """(key plus business columns, join columns) of each dimension."""
    return [
        (customer.select("cust_id", "customer_id"), ["customer_id"]),
        (product.select("prod_id", "product_id"), ["product_id"]),
        (shipping.select("ship_id", "ship_mode"), ["ship_mode"]),
        (geo.select("geo_id", "postal_code", "city", "state"),
         ["postal_code", "city", "state"]),
    ]


def repeating(lookups: list[tuple[DataFrame, list[str]]]) -> list[bool]:
    """Which of ``lookups`` hold a business key (without NULLs) in several rows; one
    job.  Meant for dimensions within the broadcast bound."""
    if not lookups:
        return []
    found = []
    for i, (dim, on) in enumerate(lookups):
        known = reduce(Column.__and__, [F.col(c).isNotNull() for c in on])
        more = dim.where(known).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
        found.append(more.agg(F.max("_n").alias("_n")).select(F.lit(i).alias("i"), "_n"))
    most = {r["i"]: r["_n"] or 0 for r in reduce(DataFrame.unionAll, found).collect()}
    return [most[i] > 1 for i in range(len(lookups))]


def key_runs(dim: DataFrame, on: list[str]) -> DataFrame | None:
    """A dimension (its key, then the columns ``on``) as one row per business key: ``on``,
    ``_first`` and ``_n``, if every business key's numbers are ``_n`` consecutive ones,
    each once; else None.  Rows with a NULL in ``on`` match nothing and are left out."""
    key = dim.columns[0]
    if dim.schema[key].dataType.typeName() not in ("integer", "long"):
        return None
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in on])
    runs = stored(dim.where(known).groupBy(*on).agg(
        F.min(key).cast("long").alias("_first"), F.max(key).cast("long").alias("_last"),
        F.count(F.lit(1)).alias("_n"), F.count_distinct(key).alias("_own")))
    gaps = runs.where(F.col("_first").isNull() | (F.col("_own") != F.col("_n"))
                      | (F.col("_last") - F.col("_first") + 1 != F.col("_n")))
    return None if gaps.take(1) else runs.select(*on, "_first", "_n")


def sales_fact(stg: DataFrame, customer: DataFrame, product: DataFrame,
               shipping: DataFrame, geo: DataFrame,
               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
               hot_share: float | None = DEFAULT_HOT_SHARE,
               salts: int | None = None) -> DataFrame:
    """The fact; ``max_broadcast_bytes`` bounds the sum of what is broadcast.
    Beyond it ``stg`` is read once more for the hot keys of all lookups, so give
    a table or a projection of one, or set ``hot_share=None``."""
    dims = dimension_lookups(customer, product, shipping, geo)
    sizes = [x.bytes for x in measure_all([dim for dim, _ in dims])]
    small = first_to_fit(sizes, max_broadcast_bytes)
    runs = {}
    for i, fits in enumerate(small):
        found = None if fits else key_runs(*dims[i])
        size = measure(found).bytes if found is not None else sizes[i]
        if size < sizes[i]:
            runs[i], sizes[i] = dims[i][0].columns[0], size
            dims[i] = (found, dims[i][1])
    small = first_to_fit(sizes, max_broadcast_bytes) if runs else small
    large = [on for (_, on), fits in zip(dims, small) if not fits]
    hot = hot_keys(stg, large, hot_share) if hot_share is not None else [[] for _ in large]
    hot = {tuple(on): h for on, h in zip(large, hot)}
    # 0: broadcast before the shuffled lookups, 1: shuffled, 2: broadcast after them.
    turn = [0 if fits else 1 for fits in small]
    if large and any(small):
        broadcast = [i for i, fits in enumerate(small) if fits]
        for i, many in zip(broadcast, repeating([dims[i] for i in broadcast])):
            turn[i] = 2 if many else 0
    out = stg.select(*dict.fromkeys(c for _, on in dims for c in on),
                     date_key("order_date").alias("order_date_id"),
                     date_key("ship_date").alias("ship_date_id"), *MEASURES)
    for i in sorted(range(len(dims)), key=lambda i: turn[i]):
        dim, on = dims[i]
        out = lookup_join(out, dim, on, "left", broadcast=small[i], hot=hot.get(tuple(on)),
                          salts=salts).drop(*on)
        if i in runs:
            out = out.withColumnsRenamed({"_first": f"_first{i}", "_n": f"_n{i}"})
    for i, key in runs.items():
        first, n = F.col(f"_first{i}"), F.col(f"_n{i}")
        numbers = F.when(n.isNotNull(), F.sequence(first, first + n - 1))
        out = out.withColumn(key, F.explode_outer(numbers)).drop(f"_first{i}", f"_n{i}")
    return out.select(
        "cust_id",
        "prod_id",
        "ship_id",
        "geo_id",
        "order_date_id",
        "ship_date_id",
        *MEASURES,
    )
