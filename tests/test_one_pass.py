"""Dimensions from one scan, the mart below the fan-out, keys as bitmaps."""

from __future__ import annotations

import os
import random
import re
import tempfile

import pytest
from conftest import raw_frame, raw_row

from starweave.operators.quality import (
    orphan_rows, relationships, repeated_keys, unique_violations,
)
from starweave.plans import (
    attribute_sets, customer_dim, dimensions, geo_dim, mart_avg_shipping_duration,
    mart_from_lines, product_dim, sales_fact, shipping_dim, stg_orders,
)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def lines(spark):
    """Lines with names, segments and places that repeat, and NULLs."""
    import datetime as dt
    rnd = random.Random(5)
    day = dt.date(2020, 2, 27)
    rows = [raw_row(order_id=f"O{i}", customer_id=f"C{rnd.randint(0, 30) if i % 3 else 0}",
                    customer_name=rnd.choice(["Ann", "Bea"]), segment=rnd.choice(["A", "B", "C"]),
                    product_id=f"P{rnd.randint(0, 25)}", ship_mode=rnd.choice(["x", "y", "z"]),
                    city=rnd.choice(["Burlington", "Rome", "Oslo"]), country=rnd.choice(["US", "UK"]),
                    postal_code=rnd.choice([None, "1", "2"]), order_date=day,
                    ship_date=day + dt.timedelta(days=rnd.randint(0, 9))) for i in range(700)]
    path = os.path.join(tempfile.mkdtemp(prefix="starweave-lines-"), "raw")
    raw_frame(spark, rows).selectExpr(
        "* EXCEPT (ship_mode, ship_date, customer_id)",
        "nullif(ship_mode, 'z') AS ship_mode",
        "IF(order_id LIKE '%7', NULL, ship_date) AS ship_date",
        "IF(order_id LIKE '%11', NULL, customer_id) AS customer_id").write.parquet(path)
    return stg_orders(spark.read.parquet(path))


ALONE = {"customer_dim": customer_dim, "product_dim": product_dim, "shipping_dim": shipping_dim,
         "geo_dim": geo_dim}


def test_dimensions_of_one_scan_equal_those_made_alone(spark, lines):
    made = dimensions(lines)
    assert set(made) == set(ALONE)
    for name, alone in ALONE.items():
        want = alone(lines)
        assert made[name].columns == want.columns
        assert _rows(made[name]) == _rows(want), name
    for name, df in dimensions(lines.limit(0)).items():
        assert df.count() == 0, name


def test_dimensions_scan_the_lines_once(spark, lines, monkeypatch):
    from starweave.plans import dims
    plans = []
    real = dims.stored
    monkeypatch.setattr(dims, "stored", lambda df: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or real(df))
    dims.attribute_sets(lines)
    assert len(plans) == 1
    assert plans[0].count("FileScan") == 1 and len(re.findall(r"Exchange \w+partitioning", plans[0])) == 1
    assert "Expand" in plans[0]


@pytest.mark.parametrize("bound", [64 << 20, 0])
def test_mart_from_lines_equals_the_mart_of_the_fact(spark, lines, bound):
    d = {n: f(lines) for n, f in ALONE.items()}
    fact = sales_fact(lines, d["customer_dim"], d["product_dim"], d["shipping_dim"], d["geo_dim"])
    assert fact.count() > 1.5 * lines.count()  # it does fan out
    want = list(map(tuple, mart_avg_shipping_duration(fact, d["shipping_dim"]).collect()))
    got = mart_from_lines(lines, attribute_sets(lines), bound)
    assert list(map(tuple, got.collect())) == want and len(want) == 2
    assert list(map(tuple, mart_from_lines(lines, d, bound).collect())) == want


def test_no_step_of_the_mart_holds_more_rows_than_lines(spark, lines):
    got = mart_from_lines(lines, attribute_sets(lines))
    got.collect()
    plan = got._jdf.queryExecution().executedPlan()
    seen, todo = [], [plan]
    while todo:
        p = todo.pop()
        for inner in ("executedPlan", "plan"):  # adaptive plans and their stages hide their children
            if p.getClass().getSimpleName().endswith(("AdaptiveSparkPlanExec", "QueryStageExec")):
                try:
                    todo.append(getattr(p, inner)())
                except Exception:
                    pass
        rows = p.metrics().get("numOutputRows")
        if rows.isDefined():
            seen.append(rows.get().value())
        children = p.children()
        todo += [children.apply(i) for i in range(children.size())]
    assert len(seen) > 4 and max(seen) <= lines.count()


def _child(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k long").repartition(3)


def test_orphans_are_counted_exactly_by_bitmaps(spark):
    parents = spark.range(0, 200_000).selectExpr("id + 101 AS k")
    clean = [101 + 7 * i for i in range(2000)] + [None, None]
    orphans = [5, 5, 5, 300_000, -1, -40_000, -40_000, 200_101, 1 << 40]
    for planted in ([], orphans):
        child = _child(spark, clean + planted)
        got = relationships(child, "c", "k", parents, "k", max_broadcast_bytes=0).first()
        assert got["failures"] == len(planted)
        assert relationships(child, "c", "k", parents, "k").first()["failures"] == len(planted)
    assert relationships(child, "c", "k", parents.limit(0), "k", 0).first()["failures"] == \
        len(clean) - 2 + len(orphans)
    assert relationships(child.limit(0), "c", "k", parents, "k", 0).first()["failures"] == 0


def test_clean_children_send_bitmaps_only(spark, monkeypatch):
    from starweave.operators import quality
    plans = []
    real = quality.stored
    monkeypatch.setattr(quality, "stored", lambda df: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or real(df))
    child = spark.range(0, 50_000, 1, 4).selectExpr("id % 1000 AS _k")
    got = orphan_rows(child, spark.range(1000).selectExpr("id AS _k"))
    assert got.first()["n"] == 0
    assert "bitmap_construct_agg" in plans[0]
    assert "Exchange hashpartitioning(_k" not in plans[0]
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()


def test_more_bad_buckets_than_are_listed(spark, monkeypatch):
    from starweave.operators import quality
    monkeypatch.setattr(quality, "MAX_BUCKETS", 3)
    child = _child(spark, [i * 32768 + 1 for i in range(20)] + [1])
    parents = spark.createDataFrame([(1,), (32769,)], "k long")
    assert relationships(child, "c", "k", parents, "k", 0).first()["failures"] == 18
    assert repeated_keys(child.unionAll(child), "k") == 20


def test_repeated_keys(spark):
    clean = spark.range(0, 100_000, 1, 4).selectExpr("id + 101 AS k")
    assert repeated_keys(clean, "k") == 0
    more = clean.unionAll(_child(spark, [101, 101, 70_000, -5, -5, None, None]))
    assert repeated_keys(more, "k") == unique_violations(more, "k").count() == 3
    names = more.selectExpr("CAST(k AS STRING) AS k")
    assert repeated_keys(names, "k") == 3
    assert repeated_keys(clean.limit(0), "k") == 0
