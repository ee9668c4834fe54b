"""Quality checks pass on clean data and fail on planted violations."""

from __future__ import annotations

import decimal
import random

import pytest
from pyspark.sql import types as T

from starweave.operators.quality import (
    REPORT_COLUMNS,
    Check,
    constraint_report,
    relationships,
    run_checks,
    star_matches,
    unique,
    unique_violations,
)
from starweave.plans import DECLARED_TESTS


def _report(df):
    return {(r["test"], r["relation"], r["column_name"]): r["failures"] for r in df.collect()}


def test_unique_counts_duplicated_values_not_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (2,), (3,), (None,), (None,)], "k int")
    assert unique(df, "t", "k").first()["failures"] == 2
    assert sorted(tuple(r) for r in unique_violations(df, "k").collect()) == [(1, 3), (2, 2)]


def test_checks_report(spark):
    dim = spark.createDataFrame([(101, "a"), (102, "b"), (102, "c"), (None, "d")],
                                "cust_id long, customer_id string")
    fact = spark.createDataFrame([(101,), (101,), (999,), (999,), (None,)], "cust_id long")
    report = run_checks({"customer_dim": dim, "sales_fact": fact}, [
        Check("unique", "customer_dim", "cust_id"),
        Check("not_null", "customer_dim", "cust_id"),
        Check("relationships", "sales_fact", "cust_id", to="customer_dim", field="cust_id"),
    ])
    assert tuple(report.columns) == REPORT_COLUMNS
    rep = _report(report)
    assert rep == {
        ("unique", "customer_dim", "cust_id"): 1,
        ("not_null", "customer_dim", "cust_id"): 1,
        ("relationships", "sales_fact", "cust_id"): 2,
    }


def test_relationships_shuffle_path_agrees(spark):
    parent = spark.createDataFrame([(i,) for i in range(0, 100, 2)], "k long")
    child = spark.createDataFrame([(i % 30,) for i in range(1000)], "k long")
    a = relationships(child, "c", "k", parent, "k").first()["failures"]
    b = relationships(child, "c", "k", parent, "k", max_broadcast_bytes=0).first()["failures"]
    assert a == b == sum(1 for i in range(1000) if (i % 30) % 2 == 1)


def test_declared_tests_are_the_nine(spark):
    assert len(DECLARED_TESTS) == 9
    assert sum(t.test == "unique" for t in DECLARED_TESTS) == 4
    assert sum(t.test == "not_null" for t in DECLARED_TESTS) == 4


@pytest.mark.parametrize("max_bytes", [64 << 20, 0])
def test_star_matches_equals_row_level_joins(spark, max_bytes):
    rnd = random.Random(3)
    fact = spark.createDataFrame(
        [(rnd.choice([1, 2, 3, None]), rnd.choice([10, 20, 30])) for _ in range(300)]
        + [(1, 10)] * 100,  # a pile of copies
        "a long, b long")
    da = spark.createDataFrame([(1,), (2,), (2,)], "a long")     # key 2 repeats
    db = spark.createDataFrame([(10,), (20,), (20,), (20,)], "b long")
    got = star_matches(fact, [(da, "a"), (db, "b")], max_bytes).first()["n"]
    want = fact.join(da, "a").join(db, "b").count()
    assert got == want


def _typed(spark, rows):
    schema = T.StructType([
        T.StructField("ship_id", T.LongType()),
        T.StructField("ship_mode", T.StringType()),
    ])
    return spark.createDataFrame(rows, schema)


def test_constraints_find_nulls_long_text_and_duplicate_keys(spark):
    df = _typed(spark, [(101, "Standard Class"), (101, "Second Class"),
                        (None, "First"), (104, None), (105, "a mode that is too long")])
    rep = _report(constraint_report(df, "shipping_dim"))
    assert rep[("not_null", "shipping_dim", "ship_id")] == 1
    assert rep[("not_null", "shipping_dim", "ship_mode")] == 1
    assert rep[("max_length", "shipping_dim", "ship_mode")] == 1
    assert rep[("primary_key", "shipping_dim", "ship_id")] == 1


def test_constraints_find_numbers_that_do_not_fit(spark):
    df = spark.createDataFrame(
        [(decimal.Decimal("99999.99994"),), (decimal.Decimal("99999.99995"),),
         (decimal.Decimal("-100000"),), (decimal.Decimal("1.5"),), (None,)],
        "sales decimal(20,5)")
    rep = _report(constraint_report(df, "orders"))
    # NUMERIC(9,4): 99999.99995 rounds to 100000.0000, which needs 6 digits.
    assert rep[("numeric_range", "orders", "sales")] == 2
    assert rep[("not_null", "orders", "sales")] == 1


def test_constraints_on_clean_rows_pass(spark):
    df = _typed(spark, [(101, "Standard Class"), (102, "First Class")])
    assert set(_report(constraint_report(df, "shipping_dim")).values()) == {0}


def test_warehouse_constraints_cover_calendar_and_managers(spark):
    from starweave.plans import calendar_dim, people_dim, warehouse_constraints
    people = spark.createDataFrame([("Anna", "West"), ("A name that is too long", "East")],
                                   "person string, region string")
    rep = _report(warehouse_constraints({"calendar_dim": calendar_dim(spark),
                                         "people_dim": people_dim(people)}))
    assert rep[("primary_key", "calendar_dim", "dateid")] == 0
    assert rep[("max_length", "people_dim", "person_name")] == 1
    assert rep[("primary_key", "people_dim", "person_id")] == 0
