"""Declared table layouts of the retail warehouse.

Every table is described once, as a list of ``(column, declared SQL type,
NOT NULL)`` triples.  From that one list we derive the Spark ``StructType``
used to read the table and the checks of its limits
(``starweave.sources.limits``), which are run on a built table
(``constraint_report``) or counted while it is written (``sources.versions``).

Column names are lower case: the DDL is unquoted mixed case and PostgreSQL
folds it, while the models quote lower-case names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The declared columns of every table, in declared order.
# (column, SQL type, NOT NULL).  Copied as data from the warehouse DDL.
# ---------------------------------------------------------------------------

REPAIRED_CITY = "Burlington"  # the one city whose missing postal code is filled in

RAW_ORDERS_DDL = [
    ("row_id", "INTEGER", True),
    ("order_id", "VARCHAR(14)", True),
    ("order_date", "DATE", True),
    ("ship_date", "DATE", True),
    ("ship_mode", "VARCHAR(14)", True),
    ("customer_id", "VARCHAR(8)", True),
    ("customer_name", "VARCHAR(22)", True),
    ("segment", "VARCHAR(11)", True),
    ("country", "VARCHAR(13)", True),
    ("city", "VARCHAR(17)", True),
    ("state", "VARCHAR(20)", True),
    ("postal_code", "VARCHAR(50)", False),
    ("region", "VARCHAR(7)", True),
    ("product_id", "VARCHAR(15)", True),
    ("category", "VARCHAR(15)", True),
    ("subcategory", "VARCHAR(11)", True),
    ("product_name", "VARCHAR(127)", True),
    ("sales", "NUMERIC(9,4)", True),
    ("quantity", "INTEGER", True),
    ("discount", "NUMERIC(4,2)", True),
    ("profit", "NUMERIC(21,16)", True),
]

# The intermediate layer repeats the raw layout with an integer postal code.
RD_ORDERS_DDL = [
    (c, "INTEGER" if c == "postal_code" else t, nn) for c, t, nn in RAW_ORDERS_DDL
]

RETURNS_DDL = [
    ("returned", "VARCHAR(17)", True),
    ("order_id", "VARCHAR(20)", True),
]

PEOPLE_DDL = [
    ("person", "VARCHAR(17)", True),
    ("region", "VARCHAR(7)", True),
]

# Warehouse tables as declared by the DDL.  Where the models name or type
# a column differently, the model's form is used (ship_mode, text leap flag)
# so the declared limits can be checked against what is built.
SHIPPING_DIM_DDL = [
    ("ship_id", "SERIAL", True),
    ("ship_mode", "VARCHAR(14)", True),
]

CUSTOMER_DIM_DDL = [
    ("cust_id", "SERIAL", True),
    ("customer_id", "VARCHAR(8)", True),
    ("customer_name", "VARCHAR(22)", True),
]

GEO_DIM_DDL = [
    ("geo_id", "SERIAL", True),
    ("country", "VARCHAR(13)", True),
    ("city", "VARCHAR(17)", True),
    ("state", "VARCHAR(20)", True),
    ("postal_code", "VARCHAR(20)", False),
]

PRODUCT_DIM_DDL = [
    ("prod_id", "SERIAL", True),
    ("product_id", "VARCHAR(50)", True),
    ("product_name", "VARCHAR(127)", True),
    ("category", "VARCHAR(15)", True),
    ("sub_category", "VARCHAR(11)", True),
    ("segment", "VARCHAR(11)", True),
]

CALENDAR_DIM_DDL = [
    ("dateid", "INTEGER", True),
    ("year", "INT", True),
    ("quarter", "INT", True),
    ("month", "INT", True),
    ("week", "INT", True),
    ("date", "DATE", True),
    ("week_day", "VARCHAR(20)", True),
    ("leap", "TEXT", True),
]

PEOPLE_DIM_DDL = [
    ("person_id", "SERIAL", True),
    ("person_name", "VARCHAR(17)", True),
    ("region", "VARCHAR(7)", True),
]

SALES_FACT_DDL = [
    ("cust_id", "BIGINT", True),
    ("order_date_id", "INTEGER", True),
    ("ship_date_id", "INTEGER", True),
    ("prod_id", "BIGINT", True),
    ("ship_id", "BIGINT", True),
    ("geo_id", "BIGINT", True),
    ("order_id", "VARCHAR(25)", True),
    ("sales", "NUMERIC(9,4)", True),
    ("profit", "NUMERIC(21,16)", True),
    ("quantity", "INT4", True),
    ("discount", "NUMERIC(4,2)", True),
]

# The declared fact has a key of its own, which the model does not make.
SALES_TABLE_DDL = [("sales_id", "SERIAL", True), *SALES_FACT_DDL]

# Primary keys declared by the DDL, per table.
PRIMARY_KEYS = {
    "orders": "row_id",
    "people": "person",
    "shipping_dim": "ship_id",
    "customer_dim": "cust_id",
    "geo_dim": "geo_id",
    "product_dim": "prod_id",
    "calendar_dim": "dateid",
    "people_dim": "person_id",
    "sales_table": "sales_id",
}

DECLARED = {
    "orders": RAW_ORDERS_DDL,
    "rd_orders": RD_ORDERS_DDL,
    "returns": RETURNS_DDL,
    "people": PEOPLE_DDL,
    "shipping_dim": SHIPPING_DIM_DDL,
    "customer_dim": CUSTOMER_DIM_DDL,
    "geo_dim": GEO_DIM_DDL,
    "product_dim": PRODUCT_DIM_DDL,
    "calendar_dim": CALENDAR_DIM_DDL,
    "people_dim": PEOPLE_DIM_DDL,
    "sales_fact": SALES_FACT_DDL,
    "sales_table": SALES_TABLE_DDL,
}


@dataclass(frozen=True)
class Column:
    """One declared column, with the limits its SQL type implies."""

    name: str
    sql_type: str
    not_null: bool
    spark_type: T.DataType
    max_length: int | None = None      # VARCHAR(n)
    precision: int | None = None       # NUMERIC(p, s)
    scale: int | None = None


_SIMPLE = {
    "INTEGER": T.IntegerType(),
    "INT": T.IntegerType(),
    "INT4": T.IntegerType(),
    "BIGINT": T.LongType(),
    "SERIAL": T.LongType(),
    "DATE": T.DateType(),
    "TEXT": T.StringType(),
    "BOOLEAN": T.BooleanType(),
}


def column(name: str, sql_type: str, not_null: bool) -> Column:
    t = sql_type.upper().replace(" ", "")
    if t in _SIMPLE:
        return Column(name, sql_type, not_null, _SIMPLE[t])
    m = re.fullmatch(r"VARCHAR\((\d+)\)", t)
    if m:
        return Column(name, sql_type, not_null, T.StringType(), max_length=int(m.group(1)))
    m = re.fullmatch(r"NUMERIC\((\d+),(\d+)\)", t)
    if m:
        p, s = int(m.group(1)), int(m.group(2))
        return Column(name, sql_type, not_null, T.DecimalType(p, s), precision=p, scale=s)
    raise ValueError(f"unsupported declared type {sql_type!r} for {name}")


def columns(table: str) -> list[Column]:
    return [column(*c) for c in DECLARED[table]]


def struct_type(table: str, drop: tuple[str, ...] = ()) -> T.StructType:
    """Spark schema for a declared table (nullability follows NOT NULL)."""
    return T.StructType(
        [
            T.StructField(c.name, c.spark_type, not c.not_null)
            for c in columns(table)
            if c.name not in drop
        ]
    )


RAW_ORDERS_SCHEMA = struct_type("orders")
PEOPLE_SCHEMA = struct_type("people")
