"""Semantics the models must keep exactly, on hand-made raw rows."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from conftest import raw_frame, raw_row

from starweave.plans import (
    STAGING_COLUMNS,
    customer_dim,
    geo_dim,
    mart_avg_shipping_duration,
    product_dim,
    sales_fact,
    shipping_dim,
    stg_orders,
)


def _star(stg, **kw):
    c, p, s, g = customer_dim(stg), product_dim(stg), shipping_dim(stg), geo_dim(stg)
    return c, p, s, g, sales_fact(stg, c, p, s, g, **kw)


def test_staging_columns_rename_and_repair(spark):
    raw = raw_frame(spark, [
        raw_row(city="Burlington", postal_code=None),
        raw_row(city="Burlington", postal_code="05408"),
        raw_row(city="Other", postal_code=None),
    ])
    stg = stg_orders(raw)
    assert tuple(stg.columns) == STAGING_COLUMNS
    got = sorted((r["city"], r["postal_code"]) for r in stg.collect())
    assert got == sorted([("Burlington", "05401"), ("Burlington", "05408"), ("Other", None)])


def test_T1_fact_fans_out_per_segment_and_per_name(spark):
    raw = raw_frame(spark, [
        raw_row(order_id="O1", customer_id="C1", segment="Consumer", product_id="P1"),
        raw_row(order_id="O2", customer_id="C2", segment="Corporate", product_id="P1"),
        raw_row(order_id="O3", customer_id="C3", customer_name="Bo", product_id="P2"),
        raw_row(order_id="O4", customer_id="C3", customer_name="Bob", product_id="P2"),
    ])
    stg = stg_orders(raw)
    c, p, s, g, fact = _star(stg)
    assert p.where("product_id = 'P1'").count() == 2
    assert c.where("customer_id = 'C3'").count() == 2
    per_order = Counter(r["order_id"] for r in fact.collect())
    # P1 has two product rows; C3 has two customer rows (and P2 one product row).
    assert per_order == {"O1": 2, "O2": 2, "O3": 2, "O4": 2}


def test_T2_null_postal_outside_burlington_has_no_geo_key(spark):
    raw = raw_frame(spark, [
        raw_row(order_id="A", city="Burlington", postal_code=None, state="VT"),
        raw_row(order_id="B", city="Burlington", postal_code="05408", state="VT"),
        raw_row(order_id="C", city="Elsewhere", postal_code=None, state="VT"),
    ])
    stg = stg_orders(raw)
    c, p, s, g, fact = _star(stg)
    rows = {r["order_id"]: r["geo_id"] for r in fact.collect()}
    assert rows["A"] is not None and rows["B"] is not None
    assert rows["C"] is None
    # The NULL geography row is still in the dimension, numbered last.
    last = g.orderBy("geo_id").collect()[-1]
    assert last["postal_code"] is None and last["city"] == "Elsewhere"


def test_T3_geo_match_ignores_country(spark):
    raw = raw_frame(spark, [
        raw_row(order_id="A", country="US", city="Paris", state="TX", postal_code="75460"),
        raw_row(order_id="B", country="FR", city="Paris", state="TX", postal_code="75460"),
    ])
    c, p, s, g, fact = _star(stg_orders(raw))
    assert g.count() == 2
    assert Counter(r["order_id"] for r in fact.collect()) == {"A": 2, "B": 2}


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_T4_ties_numbered_the_same_whatever_the_input_order(spark, partitions):
    rows = [raw_row(order_id=f"O{i}", product_id="P1", product_name=f"name{i % 3}",
                    segment=["Consumer", "Corporate"][i % 2]) for i in range(12)]
    rows += [raw_row(order_id=f"Q{i}", product_id="P0", product_name="zz") for i in range(3)]
    random.Random(partitions).shuffle(rows)
    p = product_dim(stg_orders(raw_frame(spark, rows, partitions)), partitions=partitions)
    got = [(r["prod_id"], r["product_id"], r["product_name"], r["segment"])
           for r in p.orderBy("prod_id").collect()]
    assert got == [
        (101, "P0", "zz", "Consumer"),
        (102, "P1", "name0", "Consumer"),
        (103, "P1", "name0", "Corporate"),
        (104, "P1", "name1", "Consumer"),
        (105, "P1", "name1", "Corporate"),
        (106, "P1", "name2", "Consumer"),
        (107, "P1", "name2", "Corporate"),
    ]


def test_fact_row_count_is_sum_of_match_products(spark):
    """Fact rows = sum over staging rows of prod(max(1, matches per dimension))."""
    rnd = random.Random(1)
    rows = []
    for i in range(300):
        cust = "C0" if i % 3 == 0 else f"C{rnd.randint(1, 9)}"  # C0: a third of the rows
        rows.append(raw_row(
            order_id=f"O{i}", customer_id=cust,
            customer_name=rnd.choice(["A", "B"]) if cust == "C0" else "N" + cust,
            product_id=f"P{rnd.randint(0, 7)}", segment=rnd.choice(["S1", "S2", "S3"]),
            ship_mode=rnd.choice(["M1", "M2"]),
            city=rnd.choice(["X", "Y", "Burlington"]),
            postal_code=rnd.choice([None, "00001", "00002"]),
            country=rnd.choice(["US", "CA"]), state=rnd.choice(["S", "T"])))
    stg = stg_orders(raw_frame(spark, rows, 4))
    c, p, s, g, fact = _star(stg)
    srows = stg.collect()
    cm = Counter(r["customer_id"] for r in c.collect())
    pm = Counter(r["product_id"] for r in p.collect())
    sm = Counter(r["ship_mode"] for r in s.collect())
    gm = Counter((r["postal_code"], r["city"], r["state"]) for r in g.collect()
                 if r["postal_code"] is not None)
    expect = sum(max(1, cm[r["customer_id"]]) * max(1, pm[r["product_id"]])
                 * max(1, sm[r["ship_mode"]])
                 * max(1, gm[(r["postal_code"], r["city"], r["state"])])
                 for r in srows)
    assert fact.count() == expect
    # The shuffle-join paths give the same rows: nothing broadcast (0), and
    # dimensions over the bound with the hot customer's slice under it (200).
    want = sorted(map(tuple, fact.collect()), key=str)
    for bound in (0, 200):
        *_, fact_smj = _star(stg, max_broadcast_bytes=bound)
        assert sorted(map(tuple, fact_smj.collect()), key=str) == want, bound


def test_fact_date_keys_and_mart_average(spark):
    raw = raw_frame(spark, [
        raw_row(order_id="A", ship_mode="M", order_date=dt.date(2020, 3, 4),
                ship_date=dt.date(2020, 3, 6)),
        raw_row(order_id="B", ship_mode="M", order_date=dt.date(2020, 3, 4),
                ship_date=dt.date(2020, 3, 7)),
        raw_row(order_id="C", ship_mode="N", order_date=dt.date(2020, 3, 10),
                ship_date=dt.date(2020, 3, 1)),
    ])
    c, p, s, g, fact = _star(stg_orders(raw))
    keys = {r["order_id"]: (r["order_date_id"], r["ship_date_id"]) for r in fact.collect()}
    assert keys["A"] == (20200304, 20200306)
    mart = mart_avg_shipping_duration(fact, s).collect()
    assert [(r["ship_mode"], str(r["avg_shipping_days"])) for r in mart] == \
        [("M", "2.50"), ("N", "-9.00")]


def test_staging_casts_text_dates_like_the_database(spark):
    from pyspark.sql import functions as F
    base = raw_frame(spark, [raw_row()]).drop("order_date", "ship_date")
    ok = base.withColumn("order_date", F.lit("2016-11-08")) \
        .withColumn("ship_date", F.lit("2016-11-10"))
    row = stg_orders(ok).first()
    assert row["order_date"] == dt.date(2016, 11, 8) and row["ship_date"] == dt.date(2016, 11, 10)
    bad = ok.withColumn("order_date", F.lit("11/8/2016"))
    with pytest.raises(Exception):
        stg_orders(bad).collect()
