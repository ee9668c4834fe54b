"""

``entry(spark)`` runs the flagship model (the shipping-duration mart) on
sf0.001.  ``queries()`` maps each implemented relation or check to a
callable ``(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` gives, for each,
DuckDB SQL over the same parquet tables.  The SQL imports nothing from the
package and computes its results another way: keys are places in sorted
lists, lookups are lists of matches, the star count and the mart are sums
over order lines of how often they match, declared limits are written out.

Every query reads the full test tables.  ``calendar_dim`` is not registered:
it is generated from two fixed dates and reads no table (it is tested in
``tests/test_calendar.py``); its date parts are, over the tables' dates.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The package sits next to this file; make it importable however this file is loaded.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from starweave.operators.quality import constraint_report  # noqa: E402
from starweave.plans import (  # noqa: E402
    attribute_sets,
    business_key_tests,
    create_loadable,
    customer_dim,
    date_parts,
    declared_tests,
    dimensions,
    geo_dim,
    insert_rows,
    mart_from_lines,
    people_dim,
    product_dim,
    repaired_geography,
    sales_fact,
    shipping_dim,
    star_integrity,
    stg_orders,
    warehouse_constraints,
)
from starweave.session import ensure_checkpoint_dir, stored  # noqa: E402
from starweave.sources import (  # noqa: E402
    people_from_tpch, raw_orders_from_tpch, write_observed,
)
from starweave.sources.versions import delete_folder  # noqa: E402

# The training-data operators are a separate subpackage; everything else works without it.
try:
    from starweave.llm import queries as llm  # noqa: E402
    import corpus_pipeline  # noqa: E402
except ImportError:
    llm = corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

CUSTOMER = ("customer_id", "customer_name")
PRODUCT = ("product_id", "product_name", "category", "sub_category", "segment")
GEO = ("country", "city", "state", "postal_code")
KEYED = (*CUSTOMER, *PRODUCT, *GEO, "ship_mode")
DATES = ("order_date", "ship_date")
MEASURES = ("order_id", "sales", "quantity", "discount", "profit")


def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging over the adapter's joins, lazily: each consumer reads only the
    columns it needs."""
    return stg_orders(raw_orders_from_tpch(spark, sf_dir))


def _star(spark: SparkSession, sf_dir: str, lines: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The dimensions, and the fact as a plan.  All five read the staging
    rows, so these are written once with the columns that are needed."""
    stg = stored(_staging(spark, sf_dir).select(*KEYED, *lines))
    m = dimensions(stg)
    whole = stg.select("*", *[F.lit(None).cast("date").alias(c) for c in DATES if c not in lines],
                       *[F.lit(None).alias(c) for c in MEASURES if c not in lines])
    m["sales_fact"] = sales_fact(whole, m["customer_dim"], m["product_dim"],
                                 m["shipping_dim"], m["geo_dim"])
    return m


def q_stg_orders(spark, sf_dir):
    return _staging(spark, sf_dir)


def q_customer_dim(spark, sf_dir):
    return customer_dim(_staging(spark, sf_dir))


def q_product_dim(spark, sf_dir):
    return product_dim(_staging(spark, sf_dir))


def q_shipping_dim(spark, sf_dir):
    return shipping_dim(_staging(spark, sf_dir))


def q_geo_dim(spark, sf_dir):
    return geo_dim(_staging(spark, sf_dir))


def q_date_parts(spark, sf_dir):
    stg = _staging(spark, sf_dir)
    days = stg.select(F.explode(F.array(*DATES)).alias("date")).distinct()
    return date_parts(days)


def q_people_dim(spark, sf_dir):
    return people_dim(people_from_tpch(spark, sf_dir))


def q_sales_fact(spark, sf_dir):
    return _star(spark, sf_dir, (*DATES, *MEASURES))["sales_fact"]


def q_mart_avg_shipping_duration(spark, sf_dir):
    stg = stored(_staging(spark, sf_dir).select(*KEYED, *DATES))
    return mart_from_lines(stg, attribute_sets(stg))


def q_declared_tests(spark, sf_dir):
    return declared_tests(_star(spark, sf_dir))


def q_business_key_tests(spark, sf_dir):
    stg = stored(_staging(spark, sf_dir).select(*CUSTOMER, *PRODUCT))
    return business_key_tests({"customer_dim": customer_dim(stg),
                               "product_dim": product_dim(stg)})


def q_geo_burlington(spark, sf_dir):
    return repaired_geography(geo_dim(_staging(spark, sf_dir)))


def q_star_integrity(spark, sf_dir):
    m = _star(spark, sf_dir)
    return star_integrity(m["sales_fact"], m["shipping_dim"], m["geo_dim"],
                          m["product_dim"], m["customer_dim"])


def q_constraints_raw_orders(spark, sf_dir):
    # The test tables have no row number.
    return constraint_report(raw_orders_from_tpch(spark, sf_dir), "orders", left_out=("row_id",))


def q_constraints_people(spark, sf_dir):
    return constraint_report(people_from_tpch(spark, sf_dir), "people")


def q_constraints_warehouse(spark, sf_dir):
    return warehouse_constraints(_star(spark, sf_dir, (*DATES, *MEASURES)))


def q_constraints_on_write(spark, sf_dir):
    """The warehouse's limits, counted while its tables are written."""
    m = _star(spark, sf_dir, (*DATES, *MEASURES))
    report = []
    for name in ("shipping_dim", "customer_dim", "geo_dim", "product_dim", "sales_fact"):
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/starweave/{uuid.uuid4().hex}"
        report += write_observed(m[name], path, name)[1]
        delete_folder(spark, path)
    return spark.createDataFrame(
        report, "test string, relation string, column_name string, failures long")


def q_customer_dim_loaded(spark, sf_dir):
    """The declared customers' table after two loads, numbered on by the second.
    (The test tables' manager and shipping names are longer than declared.)"""
    table = create_loadable(spark, "starweave_loads", "customer_dim")
    customers = stored(_staging(spark, sf_dir).select(*CUSTOMER).distinct())
    first = F.col("customer_id") < "5"
    for part in (customers.where(first), customers.where(~first)):
        insert_rows(part, table, "customer_dim", order_by=["customer_id"])
    return spark.table(table)


def entry(spark: SparkSession) -> DataFrame:
    return q_mart_avg_shipping_duration(spark, SMOKE_DIR)


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**llm.queries(), "pipeline": corpus_pipeline.run} if llm else {}


def _llm_oracles() -> dict[str, str]:
    if not llm:
        return {}
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**llm.oracle_sql(), **pipeline}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        **_llm_queries(),
        "stg_orders": q_stg_orders,
        "customer_dim": q_customer_dim,
        "product_dim": q_product_dim,
        "shipping_dim": q_shipping_dim,
        "geo_dim": q_geo_dim,
        "people_dim": q_people_dim,
        "customer_dim_loaded": q_customer_dim_loaded,
        "date_parts": q_date_parts,
        "sales_fact": q_sales_fact,
        "mart_avg_shipping_duration": q_mart_avg_shipping_duration,
        "declared_tests": q_declared_tests,
        "business_key_tests": q_business_key_tests,
        "geo_burlington": q_geo_burlington,
        "star_integrity": q_star_integrity,
        "constraints_raw_orders": q_constraints_raw_orders,
        "constraints_people": q_constraints_people,
        "constraints_warehouse": q_constraints_warehouse,
        "constraints_on_write": q_constraints_on_write,
    }


# ---------------------------------------------------------------------------
# Oracle side: DuckDB SQL, from the relations' definitions.
# ---------------------------------------------------------------------------

_RAW = """
raw_orders AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS order_id,
         CAST(o.o_orderdate AS DATE) AS order_date,
         CAST(l.l_shipdate AS DATE) AS ship_date,
         o.o_orderpriority AS ship_mode,
         CAST(c.c_custkey AS VARCHAR) AS customer_id,
         c.c_name AS customer_name,
         c.c_mktsegment AS segment,
         r.r_name AS country,
         CASE WHEN c.c_custkey % 40 = 0 THEN 'Burlington'
              ELSE 'City_' || CAST(c.c_custkey % 40 AS VARCHAR) END AS city,
         n.n_name AS state,
         CASE WHEN c.c_custkey % 40 IN (0, 1) THEN NULL
              ELSE lpad(CAST(c.c_custkey % 40 AS VARCHAR), 5, '0') END AS postal_code,
         r.r_name AS region,
         CAST(p.p_partkey AS VARCHAR) AS product_id,
         p.p_type AS category,
         p.p_brand AS subcategory,
         p.p_name AS product_name,
         CAST(l.l_extendedprice / 10 AS DECIMAL(9,4)) AS sales,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(l.l_discount AS DECIMAL(4,2)) AS discount,
         CAST(CAST(l.l_extendedprice / 100 AS DECIMAL(9,4)) AS DECIMAL(21,16)) AS profit
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

_STG = """
stg_orders AS (
  SELECT * REPLACE (coalesce(postal_code, map {'Burlington': '05401'}[city]) AS postal_code)
           RENAME (subcategory AS sub_category)
  FROM raw_orders
)"""


def _numbered(rel: str, key: str, cols: tuple[str, ...], order: tuple[str, ...]) -> str:
    """Distinct rows as structs in a sorted list (a NULL field sorts last);
    a row's key is 100 and its place."""
    fields = ", ".join(f"{c} := {c}" for c in (*order, *(c for c in cols if c not in order)))
    return f"""
{rel} AS (
  SELECT 100 + place AS {key}, {', '.join(f'r.{c} AS {c}' for c in cols)}
  FROM (SELECT unnest(l) AS r, generate_subscripts(l, 1) AS place
        FROM (SELECT list_sort(list(DISTINCT struct_pack({fields}))) AS l FROM stg_orders))
)"""


_DIMS = ",".join([
    _numbered("customer_dim", "cust_id", ("customer_id", "customer_name"), ("customer_id",)),
    _numbered("product_dim", "prod_id",
              ("product_id", "product_name", "category", "sub_category", "segment"),
              ("product_id",)),
    _numbered("shipping_dim", "ship_id", ("ship_mode",), ("ship_mode",)),
    _numbered("geo_dim", "geo_id", ("country", "city", "state", "postal_code"),
              ("postal_code", "city", "state")),
])

# Every order line with the lists of keys that it matches.
_MATCHES = """
c_ids AS (SELECT customer_id, list(cust_id) AS cs FROM customer_dim GROUP BY ALL),
p_ids AS (SELECT product_id, list(prod_id) AS ps FROM product_dim GROUP BY ALL),
s_ids AS (SELECT ship_mode, list(ship_id) AS ss FROM shipping_dim GROUP BY ALL),
g_ids AS (SELECT postal_code, city, state, list(geo_id) AS gs FROM geo_dim GROUP BY ALL),
line AS (
  SELECT stg_orders.*, coalesce(cs, []) AS cs, coalesce(ps, []) AS ps, coalesce(ss, []) AS ss,
         coalesce(gs, []) AS gs
  FROM stg_orders LEFT JOIN c_ids USING (customer_id) LEFT JOIN p_ids USING (product_id)
  LEFT JOIN s_ids USING (ship_mode) LEFT JOIN g_ids USING (postal_code, city, state)
)"""

# One row for every combination of a line's matches; an empty list counts as one NULL.
_FACT = """
with_c AS (SELECT *, unnest(CASE WHEN len(cs) = 0 THEN [NULL] ELSE cs END) AS cust_id FROM line),
with_p AS (SELECT *, unnest(CASE WHEN len(ps) = 0 THEN [NULL] ELSE ps END) AS prod_id FROM with_c),
with_s AS (SELECT *, unnest(CASE WHEN len(ss) = 0 THEN [NULL] ELSE ss END) AS ship_id FROM with_p),
with_g AS (SELECT *, unnest(CASE WHEN len(gs) = 0 THEN [NULL] ELSE gs END) AS geo_id FROM with_s),
sales_fact AS (
  SELECT cust_id, prod_id, ship_id, geo_id, order_id, sales, profit, quantity, discount,
         CAST(year(order_date) * 10000 + month(order_date) * 100 + day(order_date) AS INTEGER)
           AS order_date_id,
         CAST(year(ship_date) * 10000 + month(ship_date) * 100 + day(ship_date) AS INTEGER)
           AS ship_date_id
  FROM with_g
)"""

_PEOPLE = """
people AS (
  SELECT s.s_name AS person, r.r_name AS region
  FROM supplier s
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

_LINES = "WITH " + ",".join([_RAW, _STG, _DIMS, _MATCHES])
_STAR = "WITH " + ",".join([_RAW, _STG, _DIMS, _MATCHES, _FACT])


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _unique_sql(rel: str, col: str, test: str = "unique") -> str:
    return (f"SELECT '{test}' AS test, '{rel}' AS relation, '{col}' AS column_name, "
            f"(SELECT count(*) FROM (SELECT {col} FROM {rel} WHERE {col} IS NOT NULL "
            f"GROUP BY {col} HAVING count(*) > 1) AS d) AS failures")


def _not_null_sql(rel: str, col: str) -> str:
    return (f"SELECT 'not_null' AS test, '{rel}' AS relation, '{col}' AS column_name, "
            f"(SELECT count(*) FROM {rel} WHERE {col} IS NULL) AS failures")


def _relationships_sql(rel: str, col: str, parent: str, field: str) -> str:
    return (f"SELECT 'relationships' AS test, '{rel}' AS relation, '{col}' AS column_name, "
            f"(SELECT count(*) FROM {rel} AS child LEFT JOIN {parent} AS p "
            f"ON child.{col} = p.{field} "
            f"WHERE child.{col} IS NOT NULL AND p.{field} IS NULL) AS failures")


# The declared limits, as (column, NOT NULL, longest text or
# (precision, scale)), and the primary keys.
_LIMITS = {
    "orders": (
        ("order_id", True, 14), ("order_date", True, None), ("ship_date", True, None),
        ("ship_mode", True, 14), ("customer_id", True, 8), ("customer_name", True, 22),
        ("segment", True, 11), ("country", True, 13), ("city", True, 17), ("state", True, 20),
        ("postal_code", False, 50), ("region", True, 7), ("product_id", True, 15),
        ("category", True, 15), ("subcategory", True, 11), ("product_name", True, 127),
        ("sales", True, (9, 4)), ("quantity", True, None), ("discount", True, (4, 2)),
        ("profit", True, (21, 16)),
    ),
    "people": (("person", True, 17), ("region", True, 7)),
    "shipping_dim": (("ship_id", True, None), ("ship_mode", True, 14)),
    "customer_dim": (("cust_id", True, None), ("customer_id", True, 8),
                     ("customer_name", True, 22)),
    "geo_dim": (("geo_id", True, None), ("country", True, 13), ("city", True, 17),
                ("state", True, 20), ("postal_code", False, 20)),
    "product_dim": (("prod_id", True, None), ("product_id", True, 50),
                    ("product_name", True, 127), ("category", True, 15),
                    ("sub_category", True, 11), ("segment", True, 11)),
    "sales_fact": (
        ("cust_id", True, None), ("order_date_id", True, None), ("ship_date_id", True, None),
        ("prod_id", True, None), ("ship_id", True, None), ("geo_id", True, None),
        ("order_id", True, 25), ("sales", True, (9, 4)), ("profit", True, (21, 16)),
        ("quantity", True, None), ("discount", True, (4, 2)),
    ),
}
_KEYS = {"people": "person", "shipping_dim": "ship_id", "customer_dim": "cust_id",
         "geo_dim": "geo_id", "product_dim": "prod_id"}


def _constraints_sql(rel: str, label: str | None = None) -> str:
    """One SELECT per declared limit of a relation."""
    label = label or rel
    parts = []
    for name, required, limit in _LIMITS[label]:
        head = f"SELECT '%s' AS test, '{label}' AS relation, '{name}' AS column_name, "
        if required:
            parts.append(head % "not_null" + f"count(*) - count({name}) AS failures FROM {rel}")
        if isinstance(limit, int):
            parts.append(head % "max_length" + f"count(*) FILTER (WHERE length({name}) > {limit}) "
                         f"AS failures FROM {rel}")
        elif limit:
            precision, scale = limit
            parts.append(head % "numeric_range" + "count(*) FILTER (WHERE abs(round(CAST("
                         f"{name} AS DECIMAL(38,18)), {scale})) >= {10 ** (precision - scale)}) "
                         f"AS failures FROM {rel}")
    if label in _KEYS:
        parts.append(_unique_sql(rel, _KEYS[label], "primary_key"))
    return "\nUNION ALL\n".join(parts)


_MODELS = ("shipping_dim", "customer_dim", "geo_dim", "product_dim", "sales_fact")


def oracle_sql() -> dict[str, str]:
    tests = [
        _unique_sql("shipping_dim", "ship_id"), _not_null_sql("shipping_dim", "ship_id"),
        _unique_sql("customer_dim", "cust_id"), _not_null_sql("customer_dim", "cust_id"),
        _unique_sql("geo_dim", "geo_id"), _not_null_sql("geo_dim", "geo_id"),
        _unique_sql("product_dim", "prod_id"), _not_null_sql("product_dim", "prod_id"),
        _relationships_sql("sales_fact", "cust_id", "customer_dim", "cust_id"),
    ]
    warehouse = "\nUNION ALL\n".join(
        _constraints_sql(rel) for rel in _MODELS)
    return {
        **_llm_oracles(),
        "stg_orders": _with(_RAW, _STG) + " SELECT * FROM stg_orders",
        "customer_dim": _with(_RAW, _STG, _DIMS) + " SELECT * FROM customer_dim",
        "product_dim": _with(_RAW, _STG, _DIMS) + " SELECT * FROM product_dim",
        "shipping_dim": _with(_RAW, _STG, _DIMS) + " SELECT * FROM shipping_dim",
        "geo_dim": _with(_RAW, _STG, _DIMS) + " SELECT * FROM geo_dim",
        "people_dim": _with(_PEOPLE) + """
            SELECT CAST(place AS BIGINT) AS person_id, r.person AS person_name, r.region AS region
            FROM (SELECT unnest(l) AS r, generate_subscripts(l, 1) AS place
                  FROM (SELECT list_sort(list(struct_pack(person := person, region := region)))
                        AS l FROM people))""",
        "customer_dim_loaded": _with(_RAW, _STG) + """
            SELECT row_number() OVER (ORDER BY customer_id >= '5', customer_id, customer_name)
                     AS cust_id, customer_id, customer_name
            FROM (SELECT DISTINCT customer_id, customer_name FROM stg_orders)""",
        "constraints_on_write": _STAR + "\n" + warehouse,
        "date_parts": _with(_RAW) + """
            SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS dateid,
                   CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
                   CAST(month(d) AS INTEGER) AS month, CAST(week(d) AS INTEGER) AS week,
                   d AS date, lower(strftime(d, '%a')) AS week_day,
                   CASE day(d + INTERVAL 2 MONTH - INTERVAL 1 DAY) WHEN 29 THEN 'leap'
                        ELSE 'not leap' END AS leap
            FROM (SELECT order_date AS d FROM raw_orders UNION SELECT ship_date FROM raw_orders)""",
        "sales_fact": _STAR + " SELECT * FROM sales_fact",
        "mart_avg_shipping_duration": _LINES + """,
            weighted AS (
              SELECT ship_mode, ship_date - order_date AS days,
                     len(ss) * greatest(len(cs), 1) * greatest(len(ps), 1)
                       * greatest(len(gs), 1) AS n
              FROM line
            ),
            sums AS (
              SELECT ship_mode, CAST(sum(days * n) AS HUGEINT) AS s,
                     CAST(sum(n) FILTER (WHERE days IS NOT NULL) AS HUGEINT) AS c
              FROM weighted WHERE n > 0 GROUP BY ship_mode
            )
            SELECT ship_mode,
                   CASE WHEN c > 0 THEN CAST(
                     CAST(sign(s) * ((abs(s) * 200 + c) // (2 * c)) AS DECIMAL(20,0))
                       * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) END AS avg_shipping_days
            FROM sums
            ORDER BY avg_shipping_days DESC""",
        "declared_tests": _STAR + "\n" + "\nUNION ALL\n".join(tests),
        "business_key_tests": _with(_RAW, _STG, _DIMS) + "\n"
            + _unique_sql("customer_dim", "customer_id") + "\nUNION ALL\n"
            + _unique_sql("product_dim", "product_id"),
        "geo_burlington": _with(_RAW, _STG, _DIMS)
            + " SELECT * FROM geo_dim WHERE city = 'Burlington'",
        "star_integrity": _LINES + """
            SELECT CAST(coalesce(sum(len(cs) * len(ps) * len(ss) * len(gs)), 0) AS BIGINT) AS n
            FROM line""",
        "constraints_raw_orders": _with(_RAW) + "\n" + _constraints_sql("raw_orders", "orders"),
        "constraints_people": _with(_PEOPLE) + "\n"
            + _constraints_sql("people"),
        "constraints_warehouse": _STAR + "\n" + warehouse,
    }
