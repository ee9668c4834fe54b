"""Raw tables built from the TPC-H-like test tables.

The warehouse reads one raw table of order lines; the test data ships
``lineitem``, ``orders``, ``customer``, ``part``, ``nation``, ``region`` and
``supplier`` instead.  This adapter maps them onto the raw layout (one raw row
per line item, none lost).  Its mapping is fixed so results can be compared
with an independent SQL engine:

* ids are the integer keys as text; dates are the timestamps cast to date;
* ship_mode is the order priority, segment the market segment, country and
  region the region name, state the nation name;
* city and postal code are derived from the customer key so that the
  Burlington repair and the NULL-postal path both occur;
* sales and profit are the extended price scaled into NUMERIC(9,4), profit
  widened to NUMERIC(21,16) from that exact decimal.

The joins are plain ones on foreign keys, in the order customers, orders, line
items, parts, so the widest relation is shuffled as few times as possible.
What is shuffled is kept narrow: nation and region (tiny, broadcast) come last, so that
rows carry a nation's key in place of two names, and times are cut to dates and
discounts to two digits before the joins.  Nothing is measured, which would run the
joins: the planner broadcasts what table statistics or adaptive execution
show to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.partitioning import spread
from .schemas import REPAIRED_CITY

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed values of the adapter.
CITY_CYCLE = 40                 # customer key modulo this picks city and postal code; 0: the repaired city
CITY_PREFIX = "City_"           # other cities: prefix and cycle position
NULL_POSTAL_POSITIONS = (0, 1)  # cycle positions with a NULL postal code
POSTAL_WIDTH = 5                # postal codes are zero-padded to five digits


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _city(custkey: Column) -> Column:
    pos = custkey % CITY_CYCLE
    return F.when(pos == 0, F.lit(REPAIRED_CITY)).otherwise(
        F.concat(F.lit(CITY_PREFIX), pos.cast("string"))
    )


def _postal(custkey: Column) -> Column:
    pos = custkey % CITY_CYCLE
    return F.when(~pos.isin(*NULL_POSTAL_POSITIONS),
                  F.lpad(pos.cast("string"), POSTAL_WIDTH, "0"))


DISCOUNT = "decimal(4,2)"


def raw_orders_from_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw order lines (the 20 non-key columns of the raw layout)."""
    t = {name: read_table(spark, sf_dir, name) for name in TABLES}
    geo = t["nation"].select("n_nationkey", "n_name", "n_regionkey").join(
        t["region"].select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey")
    customers = t["customer"].select(
        "c_custkey", "c_name", "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
    orders = t["orders"].select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority",
        F.col("o_custkey").alias("c_custkey")
    ).join(customers, "c_custkey")
    lineitem = spread(t["lineitem"], spark.sparkContext.defaultParallelism)
    # A discount that does not fit goes on as it is, and fails only if its line is kept.
    discount = F.col("l_discount").try_cast(DISCOUNT)
    lines = lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"),
        F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_quantity", "l_extendedprice",
        discount.alias("discount"), F.when(discount.isNull(), F.col("l_discount")).alias("misfit"),
    ).join(orders, "o_orderkey")
    rows = lines.join(t["part"].select("p_partkey", "p_name", "p_brand", "p_type"), "p_partkey") \
        .join(F.broadcast(geo), "n_nationkey")
    key = F.col("c_custkey")
    return rows.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_shipdate").alias("ship_date"),
        F.col("o_orderpriority").alias("ship_mode"),
        key.cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("country"),
        _city(key).alias("city"),
        F.col("n_name").alias("state"),
        _postal(key).alias("postal_code"),
        F.col("r_name").alias("region"),
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_name").alias("product_name"),
        (F.col("l_extendedprice") / 10).cast("decimal(9,4)").alias("sales"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.coalesce("discount", F.col("misfit").cast(DISCOUNT)).alias("discount"),
        (F.col("l_extendedprice") / 100).cast("decimal(9,4)")
        .cast("decimal(21,16)").alias("profit"),
    )


def people_from_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The managers table: supplier name as person, region name as region."""
    nation = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    region = read_table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), "r_name")
    sup = read_table(spark, sf_dir, "supplier").select("s_name", "s_nationkey")
    return sup.join(nation.join(region, "n_regionkey"), "s_nationkey").select(
        F.col("s_name").alias("person"), F.col("r_name").alias("region"))
