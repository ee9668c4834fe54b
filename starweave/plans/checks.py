"""The warehouse's checks: the nine declared model tests and the hand-run
data-quality queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import DEFAULT_BROADCAST_BYTES
from ..operators.quality import Check, constraint_report, run_checks, star_matches
from ..sources.schemas import REPAIRED_CITY

# The tests declared on the marts, in declared order.
DECLARED_TESTS = (
    Check("unique", "shipping_dim", "ship_id"),
    Check("not_null", "shipping_dim", "ship_id"),
    Check("unique", "customer_dim", "cust_id"),
    Check("not_null", "customer_dim", "cust_id"),
    Check("unique", "geo_dim", "geo_id"),
    Check("not_null", "geo_dim", "geo_id"),
    Check("unique", "product_dim", "prod_id"),
    Check("not_null", "product_dim", "prod_id"),
    Check("relationships", "sales_fact", "cust_id", to="customer_dim", field="cust_id"),
)

# Business keys: not declared, and product_id is expected to fail (one row
# per segment).  Run to show the fan-out, not as part of the declared nine.
BUSINESS_KEY_TESTS = (
    Check("unique", "customer_dim", "customer_id"),
    Check("unique", "product_dim", "product_id"),
)


def declared_tests(relations: dict[str, DataFrame],
                   max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                   in_key_order: bool = False) -> DataFrame:
    """One row per declared test: test, relation, column_name, failures."""
    return run_checks(relations, DECLARED_TESTS, max_broadcast_bytes, in_key_order)


def business_key_tests(relations: dict[str, DataFrame]) -> DataFrame:
    return run_checks(relations, BUSINESS_KEY_TESTS)


def repaired_geography(geo: DataFrame) -> DataFrame:
    """Geography rows of the repaired city (their postal code is filled)."""
    return geo.where(F.col("city") == REPAIRED_CITY)


def star_integrity(fact: DataFrame, shipping: DataFrame, geo: DataFrame,
                   product: DataFrame, customer: DataFrame,
                   max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Count of fact rows that match all four dimensions (one row, ``n``)."""
    return star_matches(
        fact,
        [(shipping, "ship_id"), (geo, "geo_id"), (product, "prod_id"), (customer, "cust_id")],
        max_broadcast_bytes,
    )


def warehouse_constraints(relations: dict[str, DataFrame]) -> DataFrame:
    """Declared NOT NULL / VARCHAR / NUMERIC / primary-key limits of the
    warehouse tables, checked on the built models that are given."""
    order = ("shipping_dim", "customer_dim", "geo_dim", "product_dim", "sales_fact",
             "calendar_dim", "people_dim")
    return reduce(DataFrame.unionAll,
                  [constraint_report(relations[name], name) for name in order
                   if name in relations])
