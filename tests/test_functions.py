"""Scalar expressions: date keys and exact averages."""

from __future__ import annotations

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.functions import (
    date_from_key,
    date_key,
    day_name,
    days_between,
    plus_months_minus_day,
    rounded_ratio,
)


def test_date_key_round_trip(spark):
    dates = [dt.date(2020, 3, 4), dt.date(1999, 12, 31), dt.date(2030, 1, 1),
             dt.date(2012, 2, 29)]
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    rows = df.select("d", date_key("d").alias("k")).select(
        "d", "k", date_from_key("k").alias("back")).collect()
    for r in rows:
        assert r["k"] == int(r["d"].strftime("%Y%m%d"))
        assert r["back"] == r["d"]


def test_date_key_is_int_and_null_safe(spark):
    df = spark.createDataFrame([(None,)], "d date")
    out = df.select(date_key("d").alias("k"))
    assert out.dtypes == [("k", "int")]
    assert out.first()["k"] is None
    assert df.select(date_from_key(F.lit(None).cast("int")).alias("x")).first()["x"] is None


def test_invalid_key_raises_under_ansi(spark):
    with pytest.raises(Exception):
        spark.range(1).select(date_from_key(F.lit(20230230))).collect()


def test_day_name_and_month_arithmetic(spark):
    df = spark.createDataFrame([(dt.date(2020, 3, 4),), (dt.date(2023, 7, 31),)], "d date")
    r = df.select(day_name("d").alias("n"), plus_months_minus_day("d").alias("p"),
                  days_between(F.lit(dt.date(2020, 3, 6)), "d").alias("g")).collect()
    assert r[0]["n"] == "wed" and r[0]["p"] == dt.date(2020, 5, 3) and r[0]["g"] == 2
    assert r[1]["p"] == dt.date(2023, 9, 29)


@pytest.mark.parametrize("total,count,want", [
    (5, 2, "2.50"),
    (107, 40, "2.68"),      # exactly 2.675: half away from zero
    (-107, 40, "-2.68"),
    (1, 3, "0.33"),
    (2, 3, "0.67"),
    (-2, 3, "-0.67"),
    (0, 5, "0.00"),
    (10**15 + 5, 10**15, "1.00"),
])
def test_rounded_ratio_is_exact(spark, total, count, want):
    df = spark.createDataFrame([(total, count)], "t long, c long")
    got = df.select(rounded_ratio(F.col("t"), F.col("c")).alias("v")).first()["v"]
    assert got == decimal.Decimal(want)


def test_rounded_ratio_zero_count_is_null(spark):
    df = spark.createDataFrame([(0, 0)], "t long, c long")
    assert df.select(rounded_ratio(F.col("t"), F.col("c")).alias("v")).first()["v"] is None
