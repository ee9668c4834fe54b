"""Rebuilds behind one switch, limits in the writing pass, loads that number on."""

from __future__ import annotations

import os

import pytest
from conftest import SF_SMALL, raw_frame, raw_row
from pyspark.sql import functions as F

from starweave.plans import build, create_loadable, insert_rows, last_key, stg_orders
from starweave.sources import LimitsBroken, create_schema, publish, write_observed
from starweave.sources.versions import versions_folder


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _versions(spark, schema, name):
    folder = versions_folder(spark, schema, name).split(":", 1)[-1]
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else []


def _fact(spark, n=20, **kw):
    from starweave.sources.schemas import columns
    row = {"cust_id": 101, "order_date_id": 20200101, "ship_date_id": 20200102, "prod_id": 101,
           "ship_id": 101, "geo_id": 101, "order_id": "O1", "sales": 1, "profit": 1, "quantity": 1,
           "discount": 0, **kw}
    kinds = {c.name: c.spark_type.simpleString() for c in columns("sales_fact")}
    values = [(F.lit(v) if not hasattr(v, "alias") else v).cast(
        "string" if k == "order_id" else "decimal(38,16)" if kinds[k].startswith("decimal")
        else kinds[k]).alias(k) for k, v in row.items()]
    return spark.range(n).select(*values)


def test_publish_switches_versions_and_keeps_one(spark):
    create_schema(spark, "ver")
    spark.sql("DROP TABLE IF EXISTS ver.t")
    for i in range(4):
        table = publish(spark.range(i + 1).selectExpr("id AS k"), "ver", "t")
        assert spark.table(table).count() == i + 1
    assert len(_versions(spark, "ver", "t")) == 2
    # A session that looked the table up before the switch can still end its scan.
    held = spark.table(table)
    publish(spark.range(50).selectExpr("id AS k"), "ver", "t")
    assert held.count() == 4 and spark.table(table).count() == 50
    # Other columns: the table is made anew.
    publish(spark.range(3).selectExpr("id AS k", "'x' AS s"), "ver", "t")
    assert spark.table(table).columns == ["k", "s"] and spark.table(table).count() == 3


def test_publish_over_a_table_that_was_saved_another_way(spark):
    create_schema(spark, "ver")
    spark.range(5).selectExpr("id AS k").write.mode("overwrite").saveAsTable("ver.managed")
    assert spark.table(publish(spark.range(2).selectExpr("id AS k"), "ver", "managed")).count() == 2


def test_a_build_that_dies_leaves_the_table_and_no_folder(spark):
    create_schema(spark, "ver")
    table = publish(spark.range(7).selectExpr("id AS k"), "ver", "dies")
    before = _versions(spark, "ver", "dies")
    bad = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("stop")))
                                  .otherwise(F.col("id")).cast("long").alias("k"))
    with pytest.raises(Exception, match="stop"):
        publish(bad, "ver", "dies")
    assert spark.table(table).count() == 7 and _versions(spark, "ver", "dies") == before


@pytest.mark.parametrize("name, change, want", [
    ("null", {"geo_id": None}, ("not_null", "geo_id", 20)),
    ("long", {"order_id": "x" * 26}, ("max_length", "order_id", 20)),
    ("range", {"sales": "99999.99996"}, ("numeric_range", "sales", 20)),
    ("width", {"discount": 100}, ("numeric_range", "discount", 20)),
])
def test_rows_that_break_a_limit_leave_the_old_table(spark, name, change, want):
    create_schema(spark, "gate")
    table = publish(_fact(spark), "gate", name, "sales_fact")
    assert dict(spark.table(table).dtypes)["sales"] == "decimal(9,4)"
    before = _versions(spark, "gate", name)
    with pytest.raises(LimitsBroken, match=f"{want[0]} {name}.{want[1]}: {want[2]}") as broken:
        publish(_fact(spark, **change), "gate", name, "sales_fact")
    assert broken.value.failures == [(want[0], name, want[1], want[2])]
    assert spark.table(table).count() == 20 and spark.table(table).where("geo_id = 101").count() == 20
    assert _versions(spark, "gate", name) == before


def test_a_repeated_primary_key_and_a_missing_column_are_refused(spark):
    create_schema(spark, "gate")
    dim = spark.range(1, 1000).selectExpr("id AS ship_id", "'a' AS ship_mode")
    publish(dim, "gate", "shipping_dim", "shipping_dim")
    with pytest.raises(LimitsBroken, match="primary_key shipping_dim.ship_id: 2"):
        publish(dim.unionAll(dim.where("ship_id IN (4, 900)")), "gate", "shipping_dim", "shipping_dim")
    with pytest.raises(LimitsBroken, match="missing_column shipping_dim.ship_mode"):
        publish(dim.select("ship_id"), "gate", "shipping_dim", "shipping_dim")
    assert spark.table("gate.shipping_dim").count() == 999
    assert "varchar(14)" in spark.sql("SHOW CREATE TABLE gate.shipping_dim").first()[0].lower()


def test_limits_are_counted_in_the_writing_pass(spark, tmp_path):
    # Rows are counted as they are read: a second scan would double the number.
    read = spark.sparkContext.accumulator(0)
    rows = _fact(spark, 30).mapInPandas(lambda it: (read.add(len(p)) or p for p in it),
                                        _fact(spark).schema)
    n, report = write_observed(rows, str(tmp_path / "v"), "sales_fact")
    assert n == 30 and read.value == 30
    assert {(t, c) for t, _, c, f in report if f} == set()
    assert len(report) == 15


def test_build_refuses_what_breaks_a_limit_and_keeps_the_warehouse(spark):
    good = [raw_row(order_id=f"O{i}", product_id=f"P{i % 5}") for i in range(30)]
    wh = build(spark, raw_frame(spark, good), marts_schema="dw_gate", enforce_limits=True)
    before = {n: _rows(wh.table(n)) for n in wh.tables}
    types = dict(wh.table("customer_dim").dtypes)
    assert types["cust_id"] == "bigint"
    assert "varchar(22)" in spark.sql("SHOW CREATE TABLE dw_gate.customer_dim").first()[0].lower()
    # No postal code: the fact's geo_id is NULL, which its declaration forbids.
    bad = good + [raw_row(order_id="O99", postal_code=None)]
    with pytest.raises(LimitsBroken, match="not_null sales_fact.geo_id: 1"):
        build(spark, raw_frame(spark, bad), marts_schema="dw_gate", enforce_limits=True)
    for n in ("sales_fact", "mart_avg_shipping_duration"):
        assert _rows(wh.table(n)) == before[n], n
    # Too long a name stops the build at the customers.
    with pytest.raises(LimitsBroken, match="max_length customer_dim.customer_name: 1"):
        build(spark, raw_frame(spark, good + [raw_row(customer_name="n" * 23)]),
              marts_schema="dw_gate", enforce_limits=True)
    assert _rows(wh.table("customer_dim")) == before["customer_dim"]


def test_two_loads_number_on_without_gap_or_repeat(spark):
    table = create_loadable(spark, "loads", "people_dim")
    assert last_key(spark, table) == 0
    one = spark.createDataFrame([("Bea", "West"), ("Ann", "East"), ("Ann", "East")],
                                "person_name string, region string")
    load = insert_rows(one, table, "people_dim", order_by=["person_name"])
    assert (load.first, load.last) == (1, 3)
    two = spark.range(500).selectExpr("concat('p', id) AS person_name", "'South' AS region") \
        .repartition(7)
    load = insert_rows(two, table, "people_dim")
    assert (load.first, load.last) == (4, 503) and last_key(spark, table) == 503
    rows = spark.table(table)
    assert [r[0] for r in rows.orderBy("person_id").collect()] == list(range(1, 504))
    assert [tuple(r) for r in rows.where("person_id < 4").orderBy("person_id").collect()] == [
        (1, "Ann", "East"), (2, "Ann", "East"), (3, "Bea", "West")]
    # Nothing to add: nothing changes.
    assert insert_rows(one.limit(0), table, "people_dim").last == 503
    assert spark.table(table).count() == 503


def test_a_refused_load_leaves_rows_and_sequence(spark):
    table = create_loadable(spark, "loads", "people_dim", "refused")
    good = spark.createDataFrame([("Ann", "East")], "person_name string, region string")
    insert_rows(good, table, "people_dim")
    bad = spark.createDataFrame([("a name far too long for it", "West"), (None, "Far too far")],
                                "person_name string, region string")
    with pytest.raises(LimitsBroken) as broken:
        insert_rows(bad, table, "people_dim")
    assert {(t, c, n) for t, _, c, n in broken.value.failures} == {
        ("max_length", "person_name", 1), ("not_null", "person_name", 1), ("max_length", "region", 1)}
    assert last_key(spark, table) == 1 and spark.table(table).count() == 1
    with pytest.raises(ValueError, match="no columns"):
        insert_rows(good.withColumn("x", F.lit(1)), table, "people_dim")
    with pytest.raises(LimitsBroken, match="missing_column"):
        insert_rows(good.drop("region"), table, "people_dim")
    assert insert_rows(good, table, "people_dim").first == 2
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()[1]
    staged = location.split(":", 1)[-1].rstrip("/") + ".loads"
    assert not os.path.isdir(staged) or os.listdir(staged) == []


def test_of_two_loads_at_one_key_the_second_is_refused(spark):
    from starweave.plans import loads
    table = create_loadable(spark, "loads", "people_dim", "raced")
    rows = spark.createDataFrame([("Ann", "East")], "person_name string, region string")
    insert_rows(rows, table, "people_dim")
    real = loads.last_key
    loads.last_key = lambda *_: 0  # it looked before the first load was there
    try:
        with pytest.raises(Exception, match="[Ee]xists"):
            insert_rows(rows, table, "people_dim")
    finally:
        loads.last_key = real
    assert [r["person_id"] for r in spark.table(table).collect()] == [1]


def test_fact_rows_get_sales_ids(spark):
    raw = raw_frame(spark, [raw_row(order_id=f"O{i}") for i in range(50)], 4)
    wh = build(spark, raw, marts_schema="dw_sales")
    table = create_loadable(spark, "loads", "sales_table", "sales_fact")
    insert_rows(wh.table("sales_fact"), table, "sales_table")
    insert_rows(wh.table("sales_fact"), table, "sales_table")
    ids = [r["sales_id"] for r in spark.table(table).collect()]
    assert sorted(ids) == list(range(1, 101))
    assert spark.table(table).columns[0] == "sales_id"
    assert stg_orders(raw).count() == 50


def test_command_line_refuses_rows_that_break_limits(spark, capsys, tmp_path):
    from starweave.__main__ import main
    from starweave.sources import raw_orders_from_tpch
    path = str(tmp_path / "raw")
    raw_orders_from_tpch(spark, SF_SMALL).withColumn(
        "row_id", F.monotonically_increasing_id().cast("int")).write.parquet(path)
    assert main(["run", "--raw-path", path, "--schema", "dw_cli_gate", "--enforce-limits"]) == 1
    assert "limit\tmax_length\tshipping_dim.ship_mode\t1" in capsys.readouterr().out
