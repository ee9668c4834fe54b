"""The warehouse models, each a plain DataFrame function, plus the checks
and the build/test of the whole project."""

from .calendar import calendar_dim, date_parts
from .checks import (
    BUSINESS_KEY_TESTS,
    DECLARED_TESTS,
    business_key_tests,
    declared_tests,
    repaired_geography,
    star_integrity,
    warehouse_constraints,
)
from .dims import (
    attribute_sets, customer_dim, dimensions, geo_dim, people_dim, product_dim, shipping_dim,
)
from .facts import sales_fact
from .loads import Load, create_loadable, insert_rows, last_key
from .marts import mart_avg_shipping_duration, mart_from_lines
from .project import Warehouse, build, run_tests
from .staging import STAGING_COLUMNS, stg_orders

__all__ = [
    "BUSINESS_KEY_TESTS",
    "DECLARED_TESTS",
    "Load",
    "STAGING_COLUMNS",
    "Warehouse",
    "attribute_sets",
    "build",
    "business_key_tests",
    "calendar_dim",
    "create_loadable",
    "customer_dim",
    "date_parts",
    "declared_tests",
    "dimensions",
    "geo_dim",
    "insert_rows",
    "last_key",
    "mart_avg_shipping_duration",
    "mart_from_lines",
    "people_dim",
    "product_dim",
    "repaired_geography",
    "sales_fact",
    "shipping_dim",
    "star_integrity",
    "stg_orders",
    "run_tests",
    "warehouse_constraints",
]
