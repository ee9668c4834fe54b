"""The adapter of the test tables: what its joins shuffle, and what they keep."""

from __future__ import annotations

import datetime as dt
import re

import pytest

from starweave.sources import raw_orders_from_tpch


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Small tables; line 2 has a discount too large for its type and no order."""
    path = str(tmp_path_factory.mktemp("tables"))
    day = dt.datetime(2020, 2, 28, 23, 30)
    tables = {
        "region": ("r_regionkey long, r_name string", [(1, "EUROPE")]),
        "nation": ("n_nationkey long, n_name string, n_regionkey long",
                   [(1, "ITALY", 1), (1, "ITALIA", 1), (2, "NOWHERE", 9)]),
        "customer": ("c_custkey long, c_name string, c_nationkey long, c_mktsegment string",
                     [(40, "Ann", 1, "A"), (41, "Bea", 2, "B"), (42, "Eve", None, "B")]),
        "supplier": ("s_name string, s_nationkey long", [("S", 1)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string",
                 [(7, "nut", "b", "t"), (7, "nut 2", "b", "t")]),
        "orders": ("o_orderkey long, o_orderdate timestamp, o_orderpriority string, o_custkey long",
                   [(1, day, "high", 40), (2, None, None, 40), (3, day, "low", 41), (4, day, "low", 42)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_shipdate timestamp, l_quantity double, "
                     "l_discount double, l_extendedprice double",
                     [(1, 7, day, 3.0, 0.07, 12.345), (9, 7, day, 3.0, 1e9, 12.0),
                      (2, 7, None, None, None, None), (3, 7, day, 1.0, 0.1, 1.0), (4, 7, day, 1.0, 0.1, 1.0)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


def test_rows_are_those_of_the_joins(spark, folder):
    got = raw_orders_from_tpch(spark, folder).select(
        "order_id", "order_date", "ship_date", "state", "country", "product_name", "discount",
        "quantity").collect()
    day = dt.date(2020, 2, 28)
    want = [(o, d, d, state, "EUROPE", part, disc, q) for state in ("ITALY", "ITALIA")
            for part in ("nut", "nut 2") for o, d, disc, q in (("1", day, "0.07", 3), ("2", None, "None", None))]
    assert sorted(map(str, [(*r[:6], str(r[6]), r[7]) for r in got])) == sorted(map(str, want))


def test_a_discount_that_does_not_fit_fails_where_its_line_is_kept(spark, folder, tmp_path):
    import shutil
    shutil.copytree(folder, tmp_path / "t")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").selectExpr(
        "* EXCEPT (l_orderkey)", "1L AS l_orderkey")
    lines.write.mode("overwrite").parquet(str(tmp_path / "t" / "lineitem.parquet"))
    if spark.conf.get("spark.sql.ansi.enabled") == "true":
        with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
            raw_orders_from_tpch(spark, str(tmp_path / "t")).collect()


def test_no_shuffled_line_carries_names_of_places_or_times(spark, folder, capsys):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw_orders_from_tpch(spark, folder).explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)
    lines = [s for s in shuffled if "p_partkey" in s and "o_orderkey" in s]
    assert len(lines) == 2  # by order, by part
    for columns in shuffled:
        if "o_orderkey" in columns:
            assert "n_name" not in columns and "r_name" not in columns
            assert "l_discount#" not in columns
