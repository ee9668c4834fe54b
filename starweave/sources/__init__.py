"""Sources and sinks: declared schemas, raw readers, the test-data adapter,
generated series and table/view writers."""

from .raw import read_people, read_raw_orders
from .schemas import DECLARED, PEOPLE_SCHEMA, RAW_ORDERS_SCHEMA, columns, struct_type
from .series import date_series
from .tables import (
    DEFAULT_TARGET_SCHEMA,
    STAGING_SCHEMA,
    create_catalog_view,
    create_declared_tables,
    create_schema,
    create_view,
    declared_ddl,
    recreate_declared_table,
    schema_name,
    write_table,
)
from .versions import LimitsBroken, publish, write_observed
from .testdata import people_from_tpch, raw_orders_from_tpch, read_table

__all__ = [
    "DECLARED",
    "DEFAULT_TARGET_SCHEMA",
    "LimitsBroken",
    "PEOPLE_SCHEMA",
    "RAW_ORDERS_SCHEMA",
    "STAGING_SCHEMA",
    "columns",
    "create_catalog_view",
    "create_declared_tables",
    "create_schema",
    "create_view",
    "date_series",
    "declared_ddl",
    "people_from_tpch",
    "raw_orders_from_tpch",
    "publish",
    "read_people",
    "read_raw_orders",
    "read_table",
    "recreate_declared_table",
    "schema_name",
    "struct_type",
    "write_observed",
    "write_table",
]
