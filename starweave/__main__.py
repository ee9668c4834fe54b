"""Command line: the run and test steps of the warehouse, its hand-run checks
and its table layout.

    python -m starweave run --raw-table stg.orders [--people-table people] [--schema dw_test]
    python -m starweave run --raw-path /data/orders.parquet [--people-path ...]
    python -m starweave test [--schema dw_test]
    python -m starweave check [--schema dw_test]
    python -m starweave layout [--staging stg] [--warehouse dw]

Under ``spark-submit`` the session comes from the submit configuration.
``run`` makes the staging view ``stg.stg_orders``; with ``--enforce-limits`` it
stops at the first table whose rows break a declared limit (exit 1).  ``test`` prints one row per
declared test and exits 1 when any test fails.  ``check`` prints the star
count, the repaired geography and the limits of the built tables that rows
break.  ``layout`` drops and creates all declared tables, empty.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans import (
    Warehouse,
    build,
    repaired_geography,
    run_tests,
    star_integrity,
    warehouse_constraints,
)
from .sources import (
    DEFAULT_TARGET_SCHEMA,
    STAGING_SCHEMA,
    LimitsBroken,
    create_declared_tables,
    read_people,
    read_raw_orders,
)

TESTED = ("shipping_dim", "customer_dim", "geo_dim", "product_dim", "sales_fact")
STAR = ("sales_fact", "shipping_dim", "geo_dim", "product_dim", "customer_dim")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="starweave")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="build the staging view and every mart")
    run.add_argument("--raw-table")
    run.add_argument("--raw-path")
    run.add_argument("--people-table")
    run.add_argument("--people-path")
    run.add_argument("--schema", default=DEFAULT_TARGET_SCHEMA)
    run.add_argument("--enforce-limits", action="store_true",
                     help="declared types; refuse tables whose rows break a declared limit")
    test = sub.add_parser("test", help="run the declared tests on built tables")
    test.add_argument("--schema", default=DEFAULT_TARGET_SCHEMA)
    check = sub.add_parser("check", help="run the hand-run checks on built tables")
    check.add_argument("--schema", default=DEFAULT_TARGET_SCHEMA)
    layout = sub.add_parser("layout", help="drop and create the declared tables, in the models' forms")
    layout.add_argument("--staging", default=STAGING_SCHEMA)
    layout.add_argument("--warehouse", default="dw")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("starweave").getOrCreate()
    if args.command == "run":
        if not (args.raw_table or args.raw_path):
            parser.error("run needs --raw-table or --raw-path")
        raw = read_raw_orders(spark, path=args.raw_path, table=args.raw_table)
        people = None
        if args.people_table or args.people_path:
            people = read_people(spark, path=args.people_path, table=args.people_table)
        relation = args.raw_table or f"parquet.`{args.raw_path}`"
        try:
            wh = build(spark, raw, people, marts_schema=args.schema, raw_relation=relation,
                       enforce_limits=args.enforce_limits)
        except LimitsBroken as broken:
            for test, table, column, n in broken.failures:
                print(f"limit\t{test}\t{table}.{column}\t{n}")
            return 1
        for name, table in wh.tables.items():
            print(f"{name}\t{table}")
        return 0

    if args.command == "layout":
        for table in create_declared_tables(spark, args.staging, args.warehouse):
            print(table)
        return 0

    schema = args.schema.strip()
    wh = Warehouse(spark, f"`{STAGING_SCHEMA}`.`stg_orders`",
                   {n: f"`{schema}`.`{n}`" for n in TESTED})
    if args.command == "check":
        tables = {n: wh.table(n) for n in TESTED}
        print(f"star rows\t{star_integrity(*(tables[n] for n in STAR)).first()['n']}")
        # A city has a handful of rows: one per state and postal code.
        for r in repaired_geography(tables["geo_dim"]).collect():
            print(f"repaired\t{r['geo_id']}\t{r['city']}\t{r['state']}\t{r['postal_code']}")
        for r in warehouse_constraints(tables).where("failures > 0").collect():
            print(f"limit\t{r['test']}\t{r['relation']}.{r['column_name']}\t{r['failures']}")
        return 0
    rows = run_tests(wh).collect()
    for r in rows:
        status = "PASS" if r["failures"] == 0 else "FAIL"
        print(f"{status}\t{r['test']}\t{r['relation']}.{r['column_name']}\t{r['failures']}")
    return 0 if all(r["failures"] == 0 for r in rows) else 1


if __name__ == "__main__":
    sys.exit(main())
