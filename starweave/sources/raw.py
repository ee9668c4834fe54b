"""Readers for the raw input tables (``source('stg', 'orders')``, people)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.partitioning import spread
from .schemas import PEOPLE_SCHEMA, RAW_ORDERS_SCHEMA


# Formats whose files name their columns.
_NAMED = ("parquet", "orc")


def _declared(spark: SparkSession, schema: StructType, path: str | None, table: str | None,
              fmt: str, left_out: tuple[str, ...]) -> DataFrame:
    """A table or files with the declared columns.  A column that the stored
    data lack would read as NULL, so it is an error unless it is left out."""
    if table is not None:
        stored = spark.table(table)
    elif path is None:
        raise ValueError("give a table name or a path")
    elif fmt in _NAMED:
        stored = spark.read.format(fmt).load(path)
    else:
        return spark.read.schema(schema).format(fmt).load(path)
    names = {c.lower() for c in stored.columns}
    missing = [f.name for f in schema if f.name not in names and f.name not in left_out]
    if missing:
        raise ValueError(f"{table or path}: missing columns {', '.join(missing)}")
    if table is not None:
        return stored
    present = StructType([f for f in schema if f.name in names])
    return spark.read.schema(present).format(fmt).load(path)


def read_raw_orders(spark: SparkSession, path: str | None = None, table: str | None = None,
                    fmt: str = "parquet", min_partitions: int | None = None,
                    left_out: tuple[str, ...] = ()) -> DataFrame:
    """The raw order lines, from a catalog table or from files read with the
    declared schema (no inference).  Declared columns that are missing raise,
    but for those in ``left_out``.  Files in fewer than ``min_partitions``
    splits are spread over as many."""
    df = _declared(spark, RAW_ORDERS_SCHEMA, path, table, fmt, left_out)
    return df if table is not None else spread(df, min_partitions)


def read_people(spark: SparkSession, path: str | None = None, table: str | None = None,
                fmt: str = "parquet") -> DataFrame:
    """The managers table (person, region)."""
    return _declared(spark, PEOPLE_SCHEMA, path, table, fmt, ())
