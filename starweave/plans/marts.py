"""``mart_avg_shipping_duration``: average days from order to shipment per
ship mode, over the fact's rows (fanned-out rows included).

``mart_avg_shipping_duration`` reads a built fact.  ``mart_from_lines`` needs
none: it gives each order line the number of fact rows it would become."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_from_key, days_between
from ..functions.numeric import rounded_ratio
from ..operators.joins import DEFAULT_BROADCAST_BYTES, fitting_together, hot_keys, lookup_join


def mart_avg_shipping_duration(fact: DataFrame, shipping: DataFrame,
                               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES
                               ) -> DataFrame:
    """ship_mode, avg_shipping_days decimal(10,2), highest average first.

    The fact is first reduced per ship_id to (sum of days, count of days) -
    a map-side partial aggregate, so only a handful of rows is shuffled -
    then inner-joined to the shipping dimension (rows without a ship_id
    drop out) and summed per ship mode.  The average is exact, rounded half
    away from zero like ``::NUMERIC(10,2)``.
    """
    days = days_between(date_from_key("ship_date_id"), date_from_key("order_date_id"))
    per_id = fact.where(F.col("ship_id").isNotNull()).groupBy("ship_id").agg(
        F.sum(days.cast("long")).alias("_days"),
        F.count(days).alias("_n"),
    )
    joined = lookup_join(per_id, shipping.select("ship_id", "ship_mode"), ["ship_id"],
                         "inner", max_bytes=max_broadcast_bytes)
    return (
        joined.groupBy("ship_mode")
        .agg(rounded_ratio(F.sum("_days"), F.sum("_n")).alias("avg_shipping_days"))
        .orderBy(F.col("avg_shipping_days").desc_nulls_first())
    )


def mart_from_lines(stg: DataFrame, sets: dict[str, DataFrame],
                    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """The mart from order lines and the dimensions' rows (``sets``, as of
    ``attribute_sets`` or the dimensions themselves), aggregated below the fan-out.

    A line becomes one fact row per match in each dimension (one without any;
    none without a shipping mode).  So each dimension is counted by its
    lookup columns, a line's weight is the product of the counts it meets, and days
    and rows are summed with that weight: no plan step holds more rows than there
    are lines, and no keys are made.  Exact in integers, as the mart of a fact.
    """
    lookups = [("customer_dim", ["customer_id"]), ("product_dim", ["product_id"]),
               ("geo_dim", ["postal_code", "city", "state"]), ("shipping_dim", ["ship_mode"])]
    small = fitting_together([sets[name].select(*on, F.lit(0).cast("long").alias("_m"))
                              for name, on in lookups], max_broadcast_bytes)
    large = [on for (_, on), fits in zip(lookups, small) if not fits]
    hot = {tuple(on): h for on, h in zip(large, hot_keys(stg, large))}
    keys = list(dict.fromkeys(c for _, on in lookups for c in on))
    acc = stg.select(*keys, days_between("ship_date", "order_date").cast("long").alias("_days"),
                     F.lit(1).cast("long").alias("_w"))
    for (name, on), fits in sorted(zip(lookups, small), key=lambda x: x[1]):
        counts = sets[name].groupBy(*on).agg(F.count(F.lit(1)).alias("_m"))
        acc = lookup_join(acc, counts, on, "inner" if name == "shipping_dim" else "left",
                          broadcast=fits, hot=hot.get(tuple(on)))
        acc = acc.withColumn("_w", F.col("_w") * F.coalesce("_m", F.lit(1))).drop("_m")
    known = F.col("_days").isNotNull()
    return (
        acc.groupBy("ship_mode")
        .agg(rounded_ratio(F.sum(F.col("_days") * F.col("_w")),
                           F.coalesce(F.sum(F.when(known, F.col("_w"))), F.lit(0)))
             .alias("avg_shipping_days"))
        .orderBy(F.col("avg_shipping_days").desc_nulls_first())
    )
