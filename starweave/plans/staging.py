"""``stg_orders``: the cleaned staging view over the raw order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.schemas import REPAIRED_CITY

# The output columns in the model's order, and the postal code
# filled in for the one repaired city.
STAGING_COLUMNS = (
    "order_id", "order_date", "ship_date", "ship_mode", "customer_id",
    "customer_name", "segment", "country", "city", "state", "postal_code",
    "region", "product_id", "category", "sub_category", "product_name",
    "sales", "quantity", "discount", "profit",
)
REPAIR_POSTAL_CODE = "05401"

# The computed ones, as SQL; every other column is taken as it is.
COMPUTED = {
    "order_date": "CAST(order_date AS DATE)",
    "ship_date": "CAST(ship_date AS DATE)",
    "postal_code": f"CASE WHEN city = '{REPAIRED_CITY}' AND postal_code IS NULL "
                   f"THEN '{REPAIR_POSTAL_CODE}' ELSE postal_code END",
    "sub_category": "subcategory",
}


def staging_expressions() -> list[str]:
    """The model's select list, for a DataFrame or a view."""
    return [f"{COMPUTED[c]} AS {c}" if c in COMPUTED else c for c in STAGING_COLUMNS]


def stg_orders(raw: DataFrame) -> DataFrame:
    """Raw columns without ``row_id``: dates cast to date, the postal code
    repaired, ``subcategory`` renamed ``sub_category``.  A pure projection,
    so Catalyst folds it into every consumer and prunes what they skip."""
    return raw.selectExpr(*staging_expressions())
