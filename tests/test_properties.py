"""Property-based checks (hypothesis) of the two custom numeric/key operators."""

from __future__ import annotations

import decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.functions import rounded_ratio
from starweave.operators.keys import surrogate_key

SLOW = settings(max_examples=8, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


def _exact(total: int, count: int):
    if count == 0:
        return None
    with decimal.localcontext() as ctx:
        ctx.prec = 60
        q = decimal.Decimal(total) / decimal.Decimal(count)
        return q.quantize(decimal.Decimal("0.01"), rounding=decimal.ROUND_HALF_UP)


@st.composite
def sum_and_count(draw):
    """A count, and a sum whose average fits NUMERIC(10,2) (beyond it the
    cast raises under ANSI mode, as the database does on overflow)."""
    c = draw(st.integers(0, 10**9))
    bound = max(c, 1) * (10**7)
    return draw(st.integers(-bound, bound)), c


@SLOW
@given(st.lists(sum_and_count(), min_size=1, max_size=200))
def test_rounded_ratio_equals_exact_decimal_rounding(spark, pairs):
    # Include exact half cents on purpose: (2k + 1) / 200 = k/100 + 0.005.
    pairs = pairs + [((2 * (t % 10**6) + 1) * (1 if t >= 0 else -1), 200) for t, _ in pairs[:20]]
    df = spark.createDataFrame(pairs, "t long, c long")
    got = [r["v"] for r in df.select(rounded_ratio(F.col("t"), F.col("c")).alias("v"))
           .collect()]
    assert got == [_exact(t, c) for t, c in pairs]


ROWS = st.lists(
    st.tuples(st.sampled_from([None, "a", "b", "c", "aa", "B"]),
              st.sampled_from([None, "x", "y"]),
              st.integers(0, 3)),
    min_size=0, max_size=60, unique=True)

SCHEMA = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("n", T.IntegerType()),
])


@SLOW
@given(ROWS, st.integers(1, 9), st.integers(1, 5))
def test_parallel_key_equals_window_key(spark, rows, partitions, input_partitions):
    df = spark.createDataFrame(rows, SCHEMA).repartition(input_partitions)
    par = sorted(map(tuple, surrogate_key(df, "sk", ["code"], partitions=partitions).collect()),
                 key=str)
    order = [F.col(c).asc_nulls_last() for c in ("code", "name", "n")]
    number = F.row_number().over(Window.orderBy(*order)) + 100
    win = sorted(map(tuple, df.select(number, *df.columns).collect()), key=str)
    assert par == win
    assert sorted(r[0] for r in par) == list(range(101, 101 + len(rows)))
