"""Dimensions: the distinct attribute sets of the staging view, each with a
dense surrogate key numbered in the model's order.

As in the models, a dimension is the DISTINCT of its columns, so it holds
one row per distinct combination - product_dim repeats a product once per
customer segment that bought it, customer_dim an id once per name.  That
fan-out is kept: the fact and the mart depend on it.

``partitions`` passes through to ``surrogate_key``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import surrogate_key
from ..session import stored

# Key bases.  Model dimensions count from 101 (100 +
# row_number); the managers table counts from 1 like a SERIAL column.
DIM_KEY_BASE = 100
PEOPLE_KEY_BASE = 0


# Each dimension's key, columns and sort columns.
MODELS = {
    "customer_dim": ("cust_id", ["customer_id", "customer_name"], ["customer_id"]),
    "product_dim": ("prod_id", ["product_id", "product_name", "category", "sub_category",
                                "segment"], ["product_id"]),
    "shipping_dim": ("ship_id", ["ship_mode"], ["ship_mode"]),
    "geo_dim": ("geo_id", ["country", "city", "state", "postal_code"],
                ["postal_code", "city", "state"]),
}


def attribute_sets(stg: DataFrame) -> dict[str, DataFrame]:
    """The distinct rows of every dimension, without keys, from one scan.

    One aggregate over grouping sets: each order line counts once for each
    dimension's columns, is combined map-side, and all four results meet in one
    exchange, told apart by the grouping's number (a missing postal code is
    still a value there).  They are written once, as distinct rows only."""
    columns = [c for _, own, _ in MODELS.values() for c in own]
    numbers = {name: sum(1 << i for i, c in enumerate(reversed(columns)) if c not in own)
               for name, (_, own, _) in MODELS.items()}
    found = stored(stg.groupingSets([own for _, own, _ in MODELS.values()], *columns).agg(
        F.grouping_id().alias("_set")))
    # Without order lines no set has a row; a grouping over nothing would have one.
    return {name: found.where(F.col("_set") == numbers[name]).select(*own)
            for name, (_, own, _) in MODELS.items()}


def dimensions(stg: DataFrame, partitions: int | None = None) -> dict[str, DataFrame]:
    """The four dimensions, as by their own functions, from one scan of ``stg``."""
    return {name: surrogate_key(rows, MODELS[name][0], MODELS[name][2], base=DIM_KEY_BASE,
                                partitions=partitions)
            for name, rows in attribute_sets(stg).items()}


def _dim(name: str, stg: DataFrame, partitions: int | None) -> DataFrame:
    key, columns, order = MODELS[name]
    return surrogate_key(stg.select(*columns).distinct(), key, order, base=DIM_KEY_BASE,
                         partitions=partitions)


def customer_dim(stg: DataFrame, partitions: int | None = None) -> DataFrame:
    """cust_id, customer_id, customer_name; numbered by customer_id."""
    return _dim("customer_dim", stg, partitions)


def product_dim(stg: DataFrame, partitions: int | None = None) -> DataFrame:
    """prod_id, product_id, product_name, category, sub_category, segment;
    numbered by product_id."""
    return _dim("product_dim", stg, partitions)


def shipping_dim(stg: DataFrame, partitions: int | None = None) -> DataFrame:
    """ship_id, ship_mode; numbered by ship_mode."""
    return _dim("shipping_dim", stg, partitions)


def geo_dim(stg: DataFrame, partitions: int | None = None) -> DataFrame:
    """geo_id, country, city, state, postal_code; numbered by postal_code,
    city, state (NULL postal codes last)."""
    return _dim("geo_dim", stg, partitions)


def people_dim(people: DataFrame, partitions: int | None = None) -> DataFrame:
    """person_id (from 1), person_name, region; numbered by person.  Every
    row given is numbered, equal rows too: which of two equal rows gets the
    lower number makes no difference."""
    named = people.select(F.col("person").alias("person_name"), "region")
    return surrogate_key(named, "person_id", ["person_name"], base=PEOPLE_KEY_BASE,
                         partitions=partitions)
