"""Sinks: schemas, declared tables, views and full-rebuild table writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .schemas import columns

DEFAULT_TARGET_SCHEMA = "dw_test"
STAGING_SCHEMA = "stg"


def schema_name(custom: str | None, default: str) -> str:
    """Where a model lands: a given custom schema name is used as is (only
    trimmed); without one, the target's default schema."""
    return default if custom is None else custom.strip()


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def declared_ddl(table: str, qualified: str) -> str:
    """``CREATE TABLE`` text for a declared table, in Spark SQL.

    VARCHAR(n) is kept: Spark then refuses a too-long value on write.
    NOT NULL is not enforced by file-based tables; the constraint report
    counts what breaks it.
    """
    cols = []
    for c in columns(table):
        if c.max_length is not None:
            t = f"VARCHAR({c.max_length})"
        else:
            t = c.spark_type.simpleString().upper()
        cols.append(f"`{c.name}` {t}")
    # Loads are folders of their own inside the table's.
    return (f"CREATE TABLE {qualified} ({', '.join(cols)}) USING parquet "
            "OPTIONS (recursiveFileLookup 'true')")


def recreate_declared_table(spark: SparkSession, schema: str, table: str,
                            name: str | None = None) -> str:
    """``DROP TABLE IF EXISTS`` then ``CREATE TABLE`` from the declaration, in
    the models' forms (``ship_mode``, text ``leap``, long keys)."""
    qualified = f"`{schema}`.`{name or table}`"
    spark.sql(f"DROP TABLE IF EXISTS {qualified}")
    spark.sql(declared_ddl(table, qualified))
    return qualified


# Where the declared tables live.  The raw layer is its own
# schema, the intermediate layer (orders, returns, people) the default schema,
# and the warehouse tables a warehouse schema.
RAW_LAYER = ("orders",)
INTERMEDIATE_LAYER = (("rd_orders", "orders"), ("returns", "returns"), ("people", "people"))
WAREHOUSE_LAYER = (("shipping_dim", "shipping_dim"), ("customer_dim", "customer_dim"),
                   ("geo_dim", "geo_dim"), ("product_dim", "product_dim"),
                   ("calendar_dim", "calendar_dim"), ("people_dim", "people_dim"),
                   ("sales_table", "sales_fact"))


def create_declared_tables(spark: SparkSession, staging: str = STAGING_SCHEMA,
                           warehouse: str = "dw", default: str = "default") -> list[str]:
    """Lay out every declared table afresh (schemas created if missing,
    tables dropped and created empty); returns the qualified names."""
    create_schema(spark, staging)
    create_schema(spark, warehouse)
    made = [recreate_declared_table(spark, staging, t) for t in RAW_LAYER]
    made += [recreate_declared_table(spark, default, t, name) for t, name in INTERMEDIATE_LAYER]
    made += [recreate_declared_table(spark, warehouse, t, name) for t, name in WAREHOUSE_LAYER]
    return made


def write_table(df: DataFrame, schema: str, name: str, fmt: str = "parquet") -> str:
    """Materialise a model as a table, rebuilt in full on every run."""
    qualified = f"`{schema}`.`{name}`"
    df.write.mode("overwrite").format(fmt).saveAsTable(qualified)
    return qualified


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Materialise a model as a view: nothing is computed; every reader
    inlines the plan, as a database view is expanded in its consumers."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def create_catalog_view(spark: SparkSession, qualified: str, expressions: list[str],
                        relation: str) -> DataFrame:
    """A view in the catalog over a table or path named in SQL: unlike
    ``create_view``, every session with the same catalog can read it."""
    spark.sql(f"CREATE OR REPLACE VIEW {qualified} AS "
              f"SELECT {', '.join(expressions)} FROM {relation}")
    return spark.table(qualified)
