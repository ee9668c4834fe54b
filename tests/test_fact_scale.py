"""The fact's lookups beyond the broadcast bound, and the limits' comparisons."""

from __future__ import annotations

import decimal
import re
from collections import Counter

from conftest import raw_frame, raw_row
from pyspark.sql import functions as F

from starweave.plans import (
    customer_dim, geo_dim, product_dim, sales_fact, shipping_dim, stg_orders,
)
from starweave.session import stored
from starweave.sources.limits import numeric_misfit


def _star(spark, gap: bool = False):
    # 400 products in four segments: as rows they take four times what runs take.
    rows = [raw_row(order_id=f"O{i}", customer_id="" if i % 11 == 0 else f"C{i % 7}",
                    product_id="" if i % 13 == 0 else f"P{i % 400:06d}",
                    segment=f"S{i // 400}", postal_code=None if i % 5 == 0 else "1")
            for i in range(1600)]
    raw = raw_frame(spark, rows)
    stg = stored(stg_orders(raw.select(*[
        F.nullif(c, F.lit("")).alias(c) if c in ("customer_id", "product_id") else c
        for c in raw.columns])))
    dims = [stored(d(stg)) for d in (customer_dim, product_dim, shipping_dim, geo_dim)]
    if gap:  # a number twice, and numbers that do not follow each other
        dims[1] = stored(dims[1].withColumn("prod_id", F.expr(
            "if(prod_id % 4 = 0, prod_id + 1, prod_id * 3)")))
    return stg, dims


def _plan(df, capsys) -> str:
    df.explain(mode="formatted")
    return capsys.readouterr().out.split("\n\n")[0]


def test_a_dimension_that_fits_as_runs_shuffles_no_order_lines(spark, capsys):
    stg, dims = _star(spark)
    want = Counter(map(tuple, sales_fact(stg, *dims).collect()))
    assert sum(want.values()) > 4 * 1400
    fact = sales_fact(stg, *dims, max_broadcast_bytes=20_000)
    head = _plan(fact, capsys)
    assert head.count("BroadcastHashJoin LeftOuter") == 4 and "SortMergeJoin" not in head
    assert Counter(map(tuple, fact.collect())) == want


def test_numbers_that_are_no_runs_are_joined_row_by_row(spark):
    stg, dims = _star(spark, gap=True)
    want = Counter(map(tuple, sales_fact(stg, *dims).collect()))
    for bound in (0, 20_000):
        fact = sales_fact(stg, *dims, max_broadcast_bytes=bound)
        assert Counter(map(tuple, fact.collect())) == want


def test_shuffled_order_lines_carry_numbers_for_the_small_dimensions(spark, capsys):
    stg, dims = _star(spark, gap=True)
    fact = sales_fact(stg, *dims, max_broadcast_bytes=5_000)
    fact.explain(mode="formatted")
    plan = capsys.readouterr().out
    assert plan.split("\n\n")[0].count("SortMergeJoin") == 1
    lines = [x for x in re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)
             if "order_id" in x]
    assert len(lines) == 1
    for text in ("ship_mode", "city", "state", "postal_code", "customer_id"):
        assert text not in lines[0]


def test_decimals_are_compared_in_their_own_type(spark):
    values = [None, "0", "99999.9999", "-99999.9999", "100000.0000", "-100000", "12345678.5"]
    df = spark.createDataFrame([(None if v is None else decimal.Decimal(v),) for v in values],
                               "v decimal(12,4)")
    fast = numeric_misfit(F.col("v"), 9, 4, df.schema["v"].dataType)
    rows = df.select("v", fast.alias("a"), numeric_misfit(F.col("v"), 9, 4).alias("b")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows]
    assert sum(r["a"] for r in rows) == 3
    # More digits than declared are rounded first: that path stays.
    assert df.select(numeric_misfit(F.lit("9.9996").cast("decimal(9,4)"), 4, 3,
                                    df.schema["v"].dataType)).first()[0] is True
    assert "round" not in str(fast)
