"""Build and test the whole warehouse: the run and test steps of the model
project, as ordinary function composition.

``build`` materialises the staging view and every mart as a table rebuilt
in full.  Each model reads the *written* tables of the models it depends on,
so a lost executor costs at most the model being written, never the chain
before it.  Intermediate files go to a folder of the build's own, which it
deletes at its end.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import DEFAULT_BROADCAST_BYTES, DEFAULT_HOT_SHARE
from ..session import owned_scratch
from ..sources.tables import (
    DEFAULT_TARGET_SCHEMA,
    STAGING_SCHEMA,
    create_catalog_view,
    create_schema,
    create_view,
    schema_name,
)
from ..sources.schemas import DECLARED
from ..sources.versions import publish
from .calendar import calendar_dim
from .checks import declared_tests
from .dims import dimensions, people_dim
from .facts import sales_fact
from .marts import mart_avg_shipping_duration
from .staging import staging_expressions, stg_orders


@dataclass
class Warehouse:
    """Names of what a build wrote, and the session to read them with."""

    spark: SparkSession
    staging_view: str
    tables: dict[str, str] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        if name == "stg_orders":
            return self.spark.table(self.staging_view)
        return self.spark.table(self.tables[name])


def build(spark: SparkSession, raw: DataFrame, people: DataFrame | None = None,
          marts_schema: str | None = DEFAULT_TARGET_SCHEMA,
          default_schema: str = "default", key_partitions: int | None = None,
          raw_relation: str | None = None, staging_schema: str = STAGING_SCHEMA,
          max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
          hot_share: float | None = DEFAULT_HOT_SHARE,
          enforce_limits: bool = False) -> Warehouse:
    """Run every model in dependency order and write each mart as a table,
    which is switched to its new rows once they are complete.

    With ``enforce_limits`` the tables get their declared types, and the first
    whose rows break a declared limit raises ``LimitsBroken``; it and the later ones
    stay as they were.  The models alone do not keep all limits (a missing
    postal code leaves ``geo_id`` NULL), so this is off by default.

    ``max_broadcast_bytes`` bounds every broadcast; ``hot_share`` is the share
    of the fact's rows from which a business key is split off a merge join
    (``None`` leaves skew to adaptive execution alone).  ``raw_relation`` names
    the raw table in SQL (``db.table`` or ``parquet.`/path```): the staging view
    is then a catalog view in ``staging_schema``, which other sessions read;
    without it, it is a view of this session."""
    target = schema_name(marts_schema, default_schema)
    create_schema(spark, target)
    if raw_relation is None:
        view = "stg_orders"
        stg = create_view(stg_orders(raw), view)
    else:
        staging = schema_name(staging_schema, default_schema)
        create_schema(spark, staging)
        view = f"`{staging}`.`stg_orders`"
        stg = create_catalog_view(spark, view, staging_expressions(), raw_relation)
    wh = Warehouse(spark, view)

    def save(name: str, df: DataFrame) -> DataFrame:
        declared = name if enforce_limits and name in DECLARED else None
        wh.tables[name] = publish(df, target, name, declared)
        return wh.table(name)

    with owned_scratch(spark):
        made = dimensions(stg, key_partitions)
        customer, product, shipping, geo = (save(n, made[n]) for n in (
            "customer_dim", "product_dim", "shipping_dim", "geo_dim"))
        save("calendar_dim", calendar_dim(spark))
        fact = save("sales_fact", sales_fact(stg, customer, product, shipping, geo,
                                             max_broadcast_bytes, hot_share))
        save("mart_avg_shipping_duration",
             mart_avg_shipping_duration(fact, shipping, max_broadcast_bytes))
        if people is not None:
            save("people_dim", people_dim(people, key_partitions))
    return wh


def run_tests(wh: Warehouse, max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """The declared tests over the written tables (one row per test).  The dimensions
    were written in key order, so a clean key is proved by its ranges."""
    names = ("shipping_dim", "customer_dim", "geo_dim", "product_dim", "sales_fact")
    return declared_tests({n: wh.table(n) for n in names}, max_broadcast_bytes,
                          in_key_order=True)
